"""Named views, ad-hoc read-only SQL and the query catalogue."""

from __future__ import annotations

import re
from functools import cache

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import DataFrame, SparkSession

_READ_ONLY = re.compile(r"^[\s(]*(select|with|from|values)\b", re.IGNORECASE)
_COMMENTS = re.compile(r"--[^\n]*|/\*.*?\*/", re.DOTALL)

# What a parsed query may consist of: nodes of plans, and what stands for names not looked up yet.
_NODES = frozenset("""Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Tail Join LateralJoin SubqueryAlias Distinct Deduplicate
Union Except Intersect Window Generate Expand Sample Pivot Unpivot UnresolvedWith WithWindowDefinition OneRowRelation OneRowRelation$
LocalRelation UnresolvedHint Values NaturalJoin UsingJoin PipeOperator RepartitionByExpression Repartition RebalancePartitions
UnresolvedRelation UnresolvedHaving UnresolvedInlineTable UnresolvedSubqueryColumnAliases UnresolvedTableValuedFunction
UnresolvedTVFAliases UnresolvedAttribute UnresolvedFunction UnresolvedStar UnresolvedStarExcept UnresolvedStarExceptOrReplace UnresolvedStarWithColumns UnresolvedRegex
UnresolvedAlias UnresolvedOrdinal UnresolvedExtractValue UnresolvedNamedLambdaVariable UnresolvedSubqueryColumnAlias
UnresolvedGenerator UnresolvedWindowExpression MultiAlias GetColumnByOrdinal NamedParameter PosParameter GroupingAnalytics
UnresolvedGroupByAll JoinHint HintInfo JoinHint$ UnresolvedOrderByAll ResolvedStar UnresolvedUnpivot UnpivotExpr ParameterizedQuery""".split())
#: Functions that call into the JVM.
_REACH_OUT = frozenset(["java_method", "reflect", "try_reflect"])
_TREES = "org.apache.spark.sql.catalyst."

# Functions for SQL users; each is a Catalyst expression, not a Python function.
SQL_FUNCTIONS = """
CREATE OR REPLACE TEMPORARY FUNCTION nettoyer_prix(t STRING) RETURNS DECIMAL(12,2)
RETURN try_cast(nullif(regexp_replace(t, '[ \\u202f€]', ''), '') AS DECIMAL(12,2));
CREATE OR REPLACE TEMPORARY FUNCTION nettoyer_prix_chiffres(t STRING) RETURNS DECIMAL(38,0)
RETURN try_cast(nullif(regexp_replace(t, '[^0-9]', ''), '') AS DECIMAL(38,0));
CREATE OR REPLACE TEMPORARY FUNCTION calculer_prix_au_m2(p DECIMAL(15,2), s DECIMAL(8,2))
RETURNS DECIMAL(15,2) RETURN CASE WHEN s > 0 AND p > 0 THEN round(p / s, 2) END;
CREATE OR REPLACE TEMPORARY FUNCTION calculer_surface_exterieure(l BIGINT, w BIGINT, h BIGINT)
RETURNS DECIMAL(15,2) RETURN CAST(2 * (l * w + l * h + w * h) AS DECIMAL(15,2));
CREATE OR REPLACE TEMPORARY FUNCTION calculer_score_attractivite(
  dpe INT, lift BOOLEAN, floor_no INT, age INT, photos INT) RETURNS DECIMAL(3,1)
RETURN CAST(greatest(1.0, least(10.0, 5.0
  + CASE WHEN dpe >= 6 THEN 2 ELSE 0 END - CASE WHEN dpe <= 3 THEN 2 ELSE 0 END
  + CASE WHEN lift THEN 1 ELSE 0 END + CASE WHEN floor_no = 1 THEN 1 ELSE 0 END
  + CASE WHEN age < 20 THEN 1 ELSE 0 END - CASE WHEN age > 100 THEN 1 ELSE 0 END
  + CASE WHEN photos >= 5 THEN 1 ELSE 0 END)) AS DECIMAL(3,1));
CREATE OR REPLACE TEMPORARY FUNCTION calculer_segment_marche(
  m2 DOUBLE, surface DOUBLE, age INT, dpe INT) RETURNS STRING
RETURN concat_ws('_',
  CASE WHEN m2 < 5000 THEN 'economique' WHEN m2 < 7000 THEN 'moyen' WHEN m2 < 10000 THEN 'superieur'
       WHEN m2 < 15000 THEN 'premium' ELSE 'luxe' END,
  CASE WHEN surface < 30 THEN 'studio' WHEN surface < 50 THEN 'appartement'
       WHEN surface < 80 THEN 'grand_appartement' WHEN surface < 120 THEN 'maison'
       ELSE 'grande_maison' END,
  CASE WHEN dpe <= 3 THEN 'renovation' WHEN age > 50 THEN 'ancien' ELSE 'standard' END);
CREATE OR REPLACE TEMPORARY FUNCTION calculer_score_attractivite_avance(
  a DECIMAL(6,3), b DECIMAL(6,3), c DECIMAL(6,3), d DECIMAL(6,3)) RETURNS DECIMAL(3,1)
RETURN CAST(round(greatest(0, least(10,
  round(round(a * 0.20 + b * 0.15 + c * 0.15 + d * 0.10, 2) / 0.60 * 10, 2))), 1) AS DECIMAL(3,1));
CREATE OR REPLACE TEMPORARY FUNCTION calculer_rentabilite(
  prix DOUBLE, m2 DOUBLE, surface DOUBLE, charges DOUBLE)
RETURNS STRUCT<loyer_estime: DOUBLE, rendement_annuel: DOUBLE, rentabilite_nette: DOUBLE>
RETURN named_struct(
  'loyer_estime', m2 * surface * 0.05D / 12D,
  'rendement_annuel', try_divide(m2 * surface * 0.05D / 12D * 12D, prix) * 100D,
  'rentabilite_nette', CASE
    WHEN charges IS NULL THEN try_divide(m2 * surface * 0.05D / 12D * 12D, prix) * 100D
    ELSE greatest(0D, try_divide(m2 * surface * 0.05D / 12D * 12D, prix) * 100D
                      - try_divide(charges, prix) * 100D) END);
CREATE OR REPLACE TEMPORARY FUNCTION analyser_potentiel_renovation(
  classe STRING, age INT, prix DOUBLE)
RETURNS STRUCT<potentiel: STRING, gain_valeur_estime: DOUBLE, investissement_estime: DOUBLE>
RETURN CASE
  WHEN classe IN ('F', 'G') AND age > 30 THEN named_struct('potentiel', 'eleve',
    'gain_valeur_estime', 0.15D, 'investissement_estime', prix * 0.10D)
  WHEN classe = 'E' THEN named_struct('potentiel', 'moyen',
    'gain_valeur_estime', 0.08D, 'investissement_estime', prix * 0.06D)
  ELSE named_struct('potentiel', 'faible',
    'gain_valeur_estime', 0.02D, 'investissement_estime', prix * 0.02D) END;
"""


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the scalar functions callable from SQL; gives their names."""
    names = []
    for statement in SQL_FUNCTIONS.split(";\n"):
        if statement.strip():
            spark.sql(statement)
            names.append(re.search(r"FUNCTION (\w+)", statement)[1])
    return names


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Temp views of the same names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def _parts(gateway, node) -> list:
    """What a node of a parsed tree, a collection or a pair is made of."""
    if is_instance_of(gateway, node, "scala.collection.Iterable"):
        found = node.iterator()
    elif is_instance_of(gateway, node, "scala.Product"):
        found = node.productIterator()
    else:
        return []
    out = []
    while found.hasNext():
        out.append(found.next())
    return [x for x in out if isinstance(x, JavaObject)]


def _forbidden(spark: SparkSession, tree) -> str | None:
    """The first thing in a parsed query that only reading needs no, or None."""
    left = [tree]
    while left:
        node = left.pop()
        package, _, name = node.getClass().getName().rpartition(".")
        if package.startswith("org.apache.spark.sql.execution") or (
                package in (f"{_TREES}plans.logical", f"{_TREES}analysis") and name not in _NODES):
            return name
        if name == "UnresolvedRelation" and node.multipartIdentifier().size() > 1:
            return "a table by path or from another catalogue"
        if name in ("UnresolvedFunction", "UnresolvedTableValuedFunction"):
            words = node.nameParts() if name == "UnresolvedFunction" else node.name()
            function = words.apply(words.size() - 1).lower()
            if function in _REACH_OUT or function not in _known_functions(spark.version) | _own_functions():
                return f"function {function}"
        left += _parts(spark.sparkContext._gateway, node)
    return None


@cache
def _known_functions(version: str) -> frozenset[str]:
    """Names of the functions that come with Spark."""
    return frozenset(r[0] for r in SparkSession.active().sql("SHOW SYSTEM FUNCTIONS").collect())


def _own_functions() -> set[str]:
    return {n.lower() for n in re.findall(r"FUNCTION (\w+)", SQL_FUNCTIONS)}


def is_read_only(spark: SparkSession, text: str) -> bool:
    """True for one query over named tables: no writes, no files by path, no calls into the JVM.

    The statement is parsed, not run, and every node and expression of the tree must be one that reading needs; literals,
    aliases and comments are free.
    """
    if not _READ_ONLY.match(_COMMENTS.sub(" ", text)):
        return False
    try:
        tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(text.strip().rstrip(";"))
    except Exception:  # does not parse: the error row of run_sql says so
        return True
    return _forbidden(spark, tree) is None


def run_sql(
    spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, args: dict | None = None
) -> DataFrame:
    """Rows of an ad-hoc query over the registered tables.

    A statement that is not a plain query, or that does not analyse, gives one row with the error.
    """
    if not is_read_only(spark, text):
        return spark.sql("SELECT :message AS erreur", args={"message": "only SELECT or WITH is allowed"})
    if tables:
        register_views(tables)
    try:
        return spark.sql(text.strip().rstrip(";"), args=args)
    except Exception as error:  # the message goes back to the person who wrote the query
        return spark.sql("SELECT :message AS erreur", args={"message": str(error).splitlines()[0]})


def run_query_catalogue(
    spark: SparkSession, path: str, tables: dict[str, DataFrame] | None = None, args: dict | None = None
) -> dict[str, DataFrame]:
    """Every ``.sql`` file of a folder as a named frame; a failing query gives the row with its error.

    ``args`` are values of named parameters (``:annee``) in the files.
    """
    if tables:
        register_views(tables)
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.sql").selectExpr(
        "regexp_extract(_metadata.file_name, '^(.*)\\\\.sql$', 1) AS name", "value"
    )
    out: dict[str, DataFrame] = {}
    for row in files.orderBy("name").collect():  # the query files of one folder
        out[row["name"]] = run_sql(spark, row["value"], args=args)
    return out
