"""Personal-data operators: detection, anonymisation, retention, rights of persons, audit."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.functions.numbers import strip, truncate_localisation
from parcela.functions.privacy import (
    SENSITIVE_PATTERNS, anonymise_name, clean_location, has_sensitive, sensitive_count,
)
from parcela.sources.versions import StoredTable, purge_before, purge_children, rewrite_subjects

KEY = "id_annonce"

# Retention terms in months of raw and aggregated data, and in days of listings.
RETENTION_DAYS = 730
RAW_MONTHS, AGGREGATED_MONTHS = 24, 36

# Columns that may not be kept, and those kept under a pseudonym.
POLICY = {
    "telephone": "drop", "conseiller_telephone": "drop", "email": "drop",
    "conseiller_email": "drop", "adresse": "drop", "iban": "drop", "photo": "drop",
    "conseiller_photo": "drop", "nom_complet": "name", "conseiller_nom": "name",
    "conseiller_nom_complet": "name", "localisation_complete": "location",
}


def detect_sensitive(df: DataFrame, text: str, out: str = "sensible") -> DataFrame:
    """Flag of sensitive text and the number of hits of each pattern."""
    counts = {f"nb_{name}": sensitive_count(F.col(text), name) for name in SENSITIVE_PATTERNS}
    total = sum((F.col(name) for name in counts), F.lit(0))
    return df.withColumns(counts).withColumn(out, total > 0)


def anonymise_names(df: DataFrame, column: str = "conseiller_nom") -> DataFrame:
    return df.withColumn(column, anonymise_name(F.col(column)))


def clean_locations(df: DataFrame, column: str = "localisation_complete") -> DataFrame:
    return df.withColumn(column, clean_location(F.col(column)))


def anonymise_personal_data(df: DataFrame) -> DataFrame:
    """Both maskings, on the columns that are present."""
    out = df
    if "conseiller_nom" in df.columns:
        out = anonymise_names(out)
    if "localisation_complete" in df.columns:
        out = clean_locations(out)
    return out


def _is_kept(date: str, as_of: str, days: int) -> Column:
    """Not older than the term; a row without a date is not older."""
    return (F.col(date) >= F.date_sub(F.lit(as_of).cast("date"), days)) | F.col(date).isNull()


def apply_retention(
    tables: dict[str, DataFrame],
    as_of: str,
    days: int = RETENTION_DAYS,
    parent: str = "annonces",
    date: str = "date_extraction",
    key: str = KEY,
) -> dict[str, DataFrame]:
    """Tables without expired listings and without children that lost their parent.

    The parent is a range filter on its date, which prunes month partitions.  Children keep
    their rows by a semi join; rows with a null key go.
    """
    kept = tables[parent].filter(_is_kept(date, as_of, days))
    keys = kept.select(key)
    out = {
        name: df.join(keys, key, "left_semi") for name, df in tables.items() if name != parent
    }
    return {parent: kept, **out}


def retention_counts(
    tables: dict[str, DataFrame],
    as_of: str,
    days: int = RETENTION_DAYS,
    parent: str = "annonces",
    date: str = "date_extraction",
    key: str = KEY,
) -> DataFrame:
    """Rows before, after and removed, per table, each table read once.

    Children are counted per listing before they meet the listings, so a listing with very many
    children is one row of the join.
    """
    keys = tables[parent].filter(_is_kept(date, as_of, days)).select(key).withColumn("_kept", F.lit(True))

    def counted(name: str, df: DataFrame) -> DataFrame:
        if name == parent:
            counts = df.agg(F.count("*").alias("avant"), F.count_if(_is_kept(date, as_of, days)).alias("apres"))
        else:
            per_listing = df.groupBy(key).agg(F.count("*").alias("_n")).join(keys, key, "left")
            counts = per_listing.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("avant"),
                F.coalesce(F.sum(F.when(F.col("_kept"), F.col("_n"))), F.lit(0)).alias("apres"),
            )
        return counts.select(F.lit(name).alias("nom_table"), "avant", "apres")

    rows = reduce(DataFrame.unionByName, [counted(n, df) for n, df in tables.items()])
    return rows.withColumn("supprimes", F.col("avant") - F.col("apres"))


def retention_cutoff(as_of: str, days: int = RETENTION_DAYS, months: int = 0) -> str:
    """The first moment that is kept, as text; whole days back, then whole months."""
    at = pd.Timestamp(as_of) - pd.Timedelta(days=days) - pd.DateOffset(months=months)
    return at.strftime("%Y-%m-%dT%H:%M:%S")


def apply_retention_stored(
    tables: dict[str, StoredTable], as_of: str, days: int = RETENTION_DAYS, parent: str = "annonces",
    date: str = "date_extraction", key: str = KEY,
) -> DataFrame:
    """Retention in storage: expired listings and their children leave the files.

    Every table is stored by the month of the listing, so whole months go without being read.  The parent goes first:
    a run that ends in between is completed by running it again.
    """
    cutoff = retention_cutoff(as_of, days)
    counts = [purge_before(tables[parent], date, cutoff).withColumn("nom_table", F.lit(parent))]
    kept = tables[parent].read()
    counts += [purge_children(t, key, kept, cutoff).withColumn("nom_table", F.lit(n)) for n, t in tables.items() if n != parent]
    return reduce(DataFrame.unionByName, counts)


def purge_layers(layers: dict[str, tuple[StoredTable, str, int]], as_of: str) -> DataFrame:
    """Each stored layer purged for its own term: (table, date column, months)."""
    counts = [purge_before(table, date, retention_cutoff(as_of, 0, months)).withColumn("nom_table", F.lit(name))
              for name, (table, date, months) in layers.items()]
    return reduce(DataFrame.unionByName, counts)


def erase_stored(layers: dict[str, StoredTable], requests: DataFrame, on: str) -> DataFrame:
    """Erasure in every layer: only files that hold one of the persons are written anew, the old ones are removed."""
    asked = requests.select(on).distinct()

    def without(rows: DataFrame) -> DataFrame:
        return rows.join(asked, on, "left_anti").select(*rows.columns)

    rows = [(name, *rewrite_subjects(table, asked, on, without)) for name, table in layers.items()]
    return asked.sparkSession.createDataFrame(rows, "couche STRING, fichiers_recrits INT, fichiers_intacts INT, supprimes LONG")


def rectify_stored(
    layers: dict[str, StoredTable], corrections: DataFrame, on: str, columns: list[str], order: str | None = None
) -> DataFrame:
    """Rectification in every layer that has the columns; see :func:`rectify_subject`."""
    rows = []
    for name, table in layers.items():
        own = [c for c in columns if c in table.schema.names]
        if own:
            rows.append((name, *rewrite_subjects(
                table, corrections, on, lambda r, own=own: rectify_subject(r, corrections, [on], own, order))[:2]))
    return corrections.sparkSession.createDataFrame(rows, "couche STRING, fichiers_recrits INT, fichiers_intacts INT")


def annonces_anonymisees(df: DataFrame, as_of: str, months: int = RAW_MONTHS) -> DataFrame:
    """Recent listings with a masked location."""
    cutoff = F.add_months(F.lit(as_of).cast("date"), -months)
    return df.filter(F.col("date_extraction") >= cutoff).select(
        KEY, "reference", "titre", "prix", "surface",
        truncate_localisation(F.col("localisation")).alias("localisation_secure"), "type_bien",
    )


def audit_sensitive_data(df: DataFrame, columns: list[str]) -> DataFrame:
    """Hits of each pattern per text column: one pass, one row per column and pattern."""
    names = [(c, p) for c in columns for p in SENSITIVE_PATTERNS]
    counts = df.agg(*[
        F.count_if(has_sensitive(F.col(c), p)).alias(f"{c}|{p}") for c, p in names
    ])
    long = counts.unpivot([], [f"`{c}|{p}`" for c, p in names], "_k", "nombre")
    return long.select(
        F.split_part("_k", F.lit("|"), F.lit(1)).alias("colonne"),
        F.split_part("_k", F.lit("|"), F.lit(2)).alias("motif"),
        "nombre",
    )


def compliance_report(retention: DataFrame, audit: DataFrame) -> DataFrame:
    """Retention and audit figures as one long table."""
    removed = retention.select(
        F.lit("retention").alias("volet"), F.col("nom_table").alias("objet"),
        F.lit("supprimes").alias("mesure"), F.col("supprimes").cast("bigint").alias("nombre"),
    )
    found = audit.select(
        F.lit("audit").alias("volet"), F.col("colonne").alias("objet"),
        F.col("motif").alias("mesure"), F.col("nombre").cast("bigint").alias("nombre"),
    )
    return removed.unionByName(found)


def access_subject(data: DataFrame, requests: DataFrame, on: list[str]) -> DataFrame:
    """Rows that concern the persons of the requests."""
    return data.join(requests.select(*on).distinct(), on, "left_semi")


def erase_subject(data: DataFrame, requests: DataFrame, on: list[str]) -> DataFrame:
    """Rows that concern none of them.  A null key matches no request and stays."""
    return data.join(requests.select(*on).distinct(), on, "left_anti")


def rectify_subject(
    data: DataFrame, corrections: DataFrame, on: list[str], columns: list[str], order: str | None = None
) -> DataFrame:
    """Data with corrected values; a null correction leaves the value as it is.

    One whole correction per key is used, the last by ``order`` and then by its values, so no row
    is multiplied and no two corrections are mixed.
    """
    record = F.struct(*([F.col(order).alias("_order")] if order else []), *columns)
    one = corrections.groupBy(*on).agg(F.max(record).alias("_new")).select(
        *on, *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in columns])
    return data.join(one, on, "left").select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)
        for c in data.columns
    ])


def rights_counts(data: DataFrame, requests: DataFrame, on: list[str], kind: str) -> DataFrame:
    """How many rows the requests of each type touch (access, rectification, suppression)."""
    asked = requests.select(*on, F.col(kind).alias("type_demande")).distinct()
    matched = data.groupBy(*on).agg(F.count("*").alias("_n"))
    return (
        asked.join(matched, on, "left").groupBy("type_demande")
        .agg(F.count("*").alias("demandes"), F.coalesce(F.sum("_n"), F.lit(0)).alias("lignes"))
    )


def valid_requests(requests: DataFrame) -> DataFrame:
    """Requests with a name, an e-mail and a known type."""
    known = F.col("type_demande").isin("acces", "rectification", "suppression")
    return requests.filter(
        (strip(F.coalesce(F.col("nom"), F.lit(""))) != "")
        & F.coalesce(F.col("email"), F.lit("")).contains("@") & known
    )


def log_access(
    spark: SparkSession, path: str, user: str, action: str, table: str, at: str, address: str | None = None
) -> None:
    """Append one access to the audit table."""
    row = [(user, action, table, address)]
    df = spark.createDataFrame(row, "user_name string, action_type string, table_name string, ip_address string")
    df.withColumn("access_time", F.lit(at).cast("timestamp")).write.mode("append").parquet(path)


def access_audit(log: DataFrame) -> DataFrame:
    """Accesses per user, table, action and day."""
    return log.groupBy(
        "user_name", "table_name", "action_type", F.to_date("access_time").alias("jour")
    ).agg(F.count("*").alias("acces"))


def drop_direct_identifiers(
    df: DataFrame, policy: dict[str, str] = POLICY
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Data under the column policy, and what was done to which column."""
    maskers = {"name": anonymise_name, "location": clean_location, "truncate": truncate_localisation}
    done = [(c, policy[c]) for c in df.columns if c in policy]
    columns = [
        maskers[policy[c]](F.col(c)).alias(c) if c in policy else F.col(c)
        for c in df.columns if policy.get(c) != "drop"
    ]
    return df.select(*columns), done


def retention_by_layer(
    layers: dict[str, tuple[DataFrame, str, int]], as_of: str
) -> dict[str, DataFrame]:
    """Each layer kept for its own term: (table, date column, months)."""
    out = {}
    for name, (df, date, months) in layers.items():
        cutoff = F.add_months(F.lit(as_of).cast("date"), -months)
        out[name] = df.filter((F.col(date) >= cutoff) | F.col(date).isNull())
    return out
