from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from parcela.operators import market, prepare
from parcela.schemas import RAW_LISTING
from parcela.sources.versions import rewrite_subjects
from parcela.streaming import dedup, events, ingest, layers

AT = "2025-01-01T00:00:00"


def _write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def _message(source, **data):
    return json.dumps({"source": source, "data": data, "timestamp": AT, "type": "t"})


@pytest.fixture()
def landed(tmp_path):
    for kind in ingest.KINDS:
        _write(tmp_path / kind, "a.json", [_message(f"{kind}_{i % 2}", n=i) for i in range(6)])
    _write(tmp_path / "file", "bad.json", ["{broken", '{"source": "no data"}', "42", "[1]"])
    return tmp_path


def _united(spark, landed):
    stamp = F.lit(AT).cast("timestamp")
    return ingest.union_sources(*[
        ingest.normalise_stream(ingest.collect_source(spark, str(landed / k)), k, stamp) for k in ingest.KINDS])


def test_normalise_keeps_good_and_rejects_bad(spark, landed):
    lines = spark.read.text(str(landed / "file"))
    good = ingest.normalise_stream(lines, "file")
    bad = ingest.rejected_lines(lines, "file")
    assert (good.count(), bad.count()) == (6, 4)
    row = good.first()
    assert (row["source"], row["normalized"], row["format"], row["processing_step"]) == (
        "file", True, "standard_v1", "normalization")
    # other kinds need no "data"
    assert ingest.normalise_stream(lines, "web").count() == 9  # scalars and arrays as well


def _reads(text):
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def test_any_json_value_is_a_message(values):
    texts = ['{"a": 1}', '{"a": 1, "a": 2}', "[1, [2]]", "[]", "{}", "42", "-1.5e3", '"x"', "true", "null", " 7 ", '"a\\"b"', '{"a": "it\'s"}',
             "NaN", "[-Infinity, NaN]", '{"NaN": "Infinity"}', '"\\u00e9"', '{"a": {"b": [{"c": null}]}}', '"\U0001f600"',
             "", " ", "{broken", "{'a': 1}", "1,2", "1],[2", "1]", "[1", "]", '{"a": 1} x', '{"a": 1} {"b": 2}', "nan", "tru", "'x'", '{"a" 1}', "01",
             '"a', '{"a": 1,}', "[1,]", "// x\n1", '"\\x"', "+1", ".5", "-", '{"a": NaNx}', '"a\tb"']
    assert values(ingest.is_json, texts) == [_reads(t) for t in texts]
    assert values(ingest.is_json, [None]) == [False]


def test_a_message_of_any_size(spark):
    big = spark.range(1).select(F.concat(F.lit('{"a": ['), F.repeat(F.lit('"it is, ", '), 13_000_000), F.lit('1]}')).alias("value"))
    assert [r[0] for r in big.select(ingest.is_json(F.col("value"))).collect()] == [True]
    cut = big.select(F.expr("substring(value, 1, length(value) - 1)").alias("value"))
    assert [r[0] for r in cut.select(ingest.is_json(F.col("value"))).collect()] == [False]


def test_stream_equals_batch_and_log_is_idempotent(spark, landed, tmp_path):
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    body = ingest.append_aggregation_log(bronze, log, AT)
    ckpt = str(tmp_path / "ckpt")
    ingest.run_available(_united(spark, landed), body, ckpt)
    rows = ingest.read_log(spark, log).collect()
    assert sum(json.loads(r["metadata"])["total_records"] for r in rows) == 24
    # nothing new: nothing is written again
    ingest.run_available(_united(spark, landed), body, ckpt)
    assert ingest.read_log(spark, log).count() == len(rows)
    # a batch that is run once more replaces itself
    stored = spark.read.schema(layers.BRONZE_SCHEMA).parquet(bronze)
    again = stored.filter("source = 'api'")
    body(again, 900)
    body(again, 900)
    assert ingest.read_log(spark, log).count() == len(rows) + 1
    meta = json.loads(ingest.read_log(spark, log).filter("id = 900").first()["metadata"])
    assert (meta["total_records"], meta["sources"]) == (6, ["api"])


def test_new_files_are_picked_up(spark, landed, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    ingest.run_available(_united(spark, landed), layers.to_bronze(out), ckpt)
    _write(landed / "api", "b.json", [_message("api_9", n=9)])
    ingest.run_available(_united(spark, landed), layers.to_bronze(out), ckpt)
    assert spark.read.schema(layers.BRONZE_SCHEMA).parquet(out).count() == 25


def test_processed_files_are_archived(spark, tmp_path):
    land, archive = tmp_path / "land", tmp_path / "archive"
    _write(land, "a.json", [_message("a", n=1)])
    ckpt, out = str(tmp_path / "ckpt"), str(tmp_path / "out")
    for name in ("b.json", "c.json"):
        stream = ingest.collect_source(spark, str(land), archive=str(archive))
        ingest.run_available(ingest.normalise_stream(stream, "file"), layers.to_bronze(out), ckpt)
        _write(land, name, [_message(name, n=1)])
    stream = ingest.collect_source(spark, str(land), archive=str(archive))
    ingest.run_available(ingest.normalise_stream(stream, "file"), layers.to_bronze(out), ckpt)
    assert spark.read.schema(layers.BRONZE_SCHEMA).parquet(out).count() == 3
    assert any(p.name == "a.json" for p in archive.rglob("*.json"))
    assert (land / "c.json").exists()  # pending until its batch is committed


@pytest.fixture()
def log(spark):
    rows = [
        (1, json.dumps({"total_records": 5, "sources": ["a", "b"]}), dt.datetime(2024, 1, 1, 10, 5)),
        (2, json.dumps({"total_records": 7, "sources": ["b"]}), dt.datetime(2024, 1, 2, 10, 5)),
        (3, json.dumps({"sources": []}), dt.datetime(2024, 1, 2, 10, 45)),
    ]
    return spark.createDataFrame(rows, "id bigint, metadata string, created_at timestamp")


def test_log_reports(log, tmp_path, spark):
    assert [r["id"] for r in ingest.latest_aggregations(log, 2).collect()] == [3, 2]
    r = ingest.aggregation_report(log).first()
    assert (r["total_aggregations"], r["total_records_processed"], r["avg_records_per_aggregation"], r["unique_sources"]) == (3, 12, 6.0, 2)
    hours = ingest.hourly_activity(log, "2024-01-02T12:00:00").collect()
    assert [(h["hour"], h["count"]) for h in hours] == [(dt.datetime(2024, 1, 2, 10), 2)]
    assert [r["id"] for r in ingest.purge_old(log, "2024-01-31T10:30:00", 29).orderBy("id").collect()] == [3]
    c = ingest.purge_counts(log, "2024-01-31T10:30:00", 29).first()
    assert (c["avant"], c["apres"], c["supprimes"]) == (3, 1, 2)
    ingest.export_latest_sample(log, str(tmp_path / "s"), AT)
    assert spark.read.json(str(tmp_path / "s")).first()["aggregation_id"] == 3
    ingest.export_latest_sample(log.limit(0), str(tmp_path / "e"), AT)
    assert spark.read.json(str(tmp_path / "e")).first()["status"] == "NO_DATA"


def test_queue_depths(spark):
    pending = spark.createDataFrame([("a",)] * 12 + [("b",)] * 3, "source string")
    got = {r["queue"]: (r["elements"], r["etat"]) for r in ingest.queue_depths(pending, ["a", "b", "c"]).collect()}
    assert got == {"a": (12, "charge"), "b": (3, "faible"), "c": (0, "vide")}


def test_message_source_falls_back(spark):
    df = spark.createDataFrame([("", "o"), (None, None), ("s", "o")], "source string, origin string")
    assert [r[0] for r in df.select(ingest.message_source(df)).collect()] == ["o", "unknown", "s"]


def _event_folder(spark, folder, rows):
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    df.coalesce(1).write.mode("append").parquet(str(folder))
    return df.schema


def test_dedup_over_batches(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    land, out, ckpt = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "ckpt")
    schema = _event_folder(spark, land, [("a", t0, 1), ("a", t0 + dt.timedelta(hours=1), 2), ("b", t0, 3)])
    body = dedup.dedup_into(out, "k", "ts", "7 days")

    def run():
        ingest.run_available(spark.readStream.schema(schema).parquet(str(land)), body, ckpt)
        return sorted((r["k"], r["v"]) for r in spark.read.schema(schema).parquet(out).collect())

    assert run() == [("a", 1), ("b", 3)]
    later = t0 + dt.timedelta(days=2)
    _event_folder(spark, land, [("a", later, 4), ("c", later, 5)])
    assert run() == [("a", 1), ("b", 3), ("c", 5)]
    # beyond the horizon a key counts as new again
    _event_folder(spark, land, [("b", t0 + dt.timedelta(days=30), 6)])
    assert run() == [("a", 1), ("b", 3), ("b", 6), ("c", 5)]


def test_native_dedup_and_windows(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0, 1), ("a", t0 + dt.timedelta(minutes=1), 2), ("b", t0, 3), ("z", t0 + dt.timedelta(days=1), 0)]
    schema = _event_folder(spark, tmp_path / "e", rows)
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "e"))
    for df, out in [
        (events.stream_dedup(stream, "k", "ts"), "dedup"),
        (events.windowed_counts(stream, "ts", ["k"], "1 hour", value="v"), "windows"),
        (events.session_stream(stream, "ts", "k"), "sessions"),
    ]:
        q = (df.writeStream.format("parquet").option("path", str(tmp_path / out))
             .option("checkpointLocation", str(tmp_path / f"c-{out}")).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "dedup")).count() == 3
    got = {r["k"]: (r["nombre"], float(r["total"])) for r in spark.read.parquet(str(tmp_path / "windows")).collect()}
    assert got == {"a": (2, 3.0), "b": (1, 3.0)}  # the window of "z" is still open
    batch = events.windowed_counts(spark.read.parquet(str(tmp_path / "e")), "ts", ["k"], "1 hour", value="v")
    closed = {r["k"]: (r["nombre"], float(r["total"])) for r in batch.collect() if r["k"] != "z"}
    assert closed == got
    sessions = {r["k"]: r["nombre"] for r in spark.read.parquet(str(tmp_path / "sessions")).collect()}
    assert sessions == {"a": 2, "b": 1}


def test_layers_end_to_end(spark, tmp_path):
    def raw(ref, price):
        row = dict.fromkeys(RAW_LISTING.names, "")
        row |= {"reference": ref, "titre": "Maison", "prix": price, "surface": "50", "pieces": "3",
                "localisation": "Paris (75001)", "images": [], "caracteristiques_detaillees": ["Cave"]}
        return json.dumps(row)

    land = tmp_path / "land"
    _write(land, "a.json", [raw("R1", "100 000"), raw("R1", "100 000"), raw("R2", "200000"), raw("", "1"), "{x"])
    bronze, silver, gold, ckpt = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "ckpt"))
    stream = ingest.normalise_stream(ingest.collect_source(spark, str(land)), "web")
    ingest.run_available(stream, layers.to_bronze(bronze), ckpt)
    assert layers.bronze_to_silver(spark, bronze, silver, 2025) == 1
    assert layers.bronze_to_silver(spark, bronze, silver, 2025) == 0  # nothing new
    assert sorted(r["reference"] for r in layers.silver_table(spark, silver).read().collect()) == ["R1", "R2"]
    layers.silver_to_gold(spark, silver, gold, AT)
    rows = {r["reference"]: r for r in layers.gold_listings(spark, gold).read().collect()}
    assert rows["R2"]["aggregats"]["performance"]["prix_m2"] == 4000.0
    assert rows["R1"]["prix"]["valeur"] is None  # an ordinary space is not removed by the document parser
    stats = spark.read.parquet(f"{gold}/market_stats").first()
    assert stats["nombre_biens_analyses"] == 1
    prepared = layers.silver_table(spark, silver).read()
    direct = market.aggregate_listings(prepared, AT).select("reference", "aggregats").collect()
    assert {r["reference"]: r["aggregats"] for r in direct} == {k: v["aggregats"] for k, v in rows.items()}
    assert prepare.prune_empty(prepared).count() == 2


def test_layers_read_each_batch_once(spark, tmp_path):
    """Gold after two batches equals one rebuild; a batch that silver has taken is not read again."""
    def raw(i):
        row = dict.fromkeys(RAW_LISTING.names, "")
        row |= {"reference": f"R{i}", "titre": "Maison", "prix": f"{90_000 + i * 1111}", "surface": str(20 + i % 50), "pieces": "3",
                "localisation": f"Paris (750{i % 20:02})", "date_extraction": f"2025-0{1 + i % 3}-02T00:00:00", "images": [],
                "caracteristiques_detaillees": []}
        return json.dumps(row)

    def bronze_of(name, first, last):
        lines = spark.createDataFrame([(raw(i),) for i in range(first, last)], "value string")
        return lambda batch_id: layers.to_bronze(str(tmp_path / name))(ingest.normalise_stream(lines, "web"), batch_id)

    paths = {n: str(tmp_path / n) for n in ("bronze", "silver", "gold", "whole", "silver1", "gold1")}

    def step():
        taken = layers.bronze_to_silver(spark, paths["bronze"], paths["silver"], 2025)
        return taken, layers.silver_to_gold(spark, paths["silver"], paths["gold"], AT)

    bronze_of("bronze", 0, 60)(0)
    assert step()[0] == 1
    for f in (tmp_path / "bronze" / "batch_id=0").glob("*.parquet"):
        f.write_bytes(b"unreadable")  # whoever reads it again fails
    assert step() == (0, 0)
    bronze_of("bronze", 50, 100)(1)
    taken, fresh = step()
    assert taken == 1 and fresh > 0
    bronze_of("whole", 0, 100)(0)
    layers.bronze_to_silver(spark, paths["whole"], paths["silver1"], 2025)
    layers.silver_to_gold(spark, paths["silver1"], paths["gold1"], AT)

    def gold(name):
        stats = spark.read.parquet(f"{paths[name]}/market_stats").first().asDict()
        return stats, {r["reference"]: r["aggregats"] for r in layers.gold_listings(spark, paths[name]).read().collect()}

    assert gold("gold") == gold("gold1") and len(gold("gold")[1]) == 100
    # what leaves silver leaves the statistics
    gone = spark.createDataFrame([("R7",)], "reference string")
    silver = layers.silver_table(spark, paths["silver"])
    rewrite_subjects(silver, gone, "reference", lambda r: r.join(gone, "reference", "left_anti").select(*r.columns))
    layers.silver_to_gold(spark, paths["silver"], paths["gold"], AT)
    stats, listings = gold("gold")
    assert stats["nombre_biens_analyses"] == 99 and "R7" not in listings


def test_bronze_is_compressed_by_zstd(spark, tmp_path):
    from parcela.streaming.layers import to_bronze

    to_bronze(str(tmp_path))(spark.createDataFrame([("x" * 100,)], "data string"), 3)
    assert list(tmp_path.rglob("*.zstd.parquet"))


def _plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_envelopes_are_parsed_once(spark):
    """A filter on the fields does not parse the text again; inner data is found however its key is written."""
    from parcela.operators.quality import filter_valid

    texts = ['{"reference": "R1", "titre": "a"}', '{"data": {"reference": "R2", "titre": "b", "images": ["x"]}}',
             '{"d\\u0061ta": {"reference": "R3", "titre": "c"}}', '{"reference": "R4", "titre": "data"}', "{'data': {'reference': 'R5', 'titre': 'd'}}",
             '{"reference": " ", "titre": "e"}', '{"reference": "R6"}', "5", "", None]
    bronze = spark.createDataFrame([(t,) for t in texts], "data string")
    valid = filter_valid(layers.raw_from_envelopes(bronze), ["titre"])
    assert [r["reference"] for r in valid.collect()] == ["R1", "R2", "R3", "R4", "R5"]
    assert _plan(valid).count("from_json(") == 1
    assert layers.raw_from_envelopes(bronze).count() == len(texts)


def test_plain_objects_need_no_second_look(spark, values):
    """What the strict parser takes is taken as before, and what only the lenient one takes is still left out."""
    good = ['{"a": "it is"}', '{"a": "it\'s"}', '{"a": 1, "a": [2, {"b": null}]}', "{}", '{"a": "x\\n"}', '{"a":\t1}', '{"a": "NaN"}', '{"a": "é"}']
    bad = ["{'a': 1}", '{"a": 1}]', '{"a": 1},0] x', '{"a": 1} x', '{"a": "x\ty"}', '{"a": "\\x"}', '{"a": 1}{"b": 2}', '{"a": 1},{"b": 2}', "{a: 1}", '{"a": 1']
    assert values(ingest.is_json, good) == [True] * len(good) and values(ingest.is_json, bad) == [False] * len(bad)
    lines = spark.createDataFrame([(good[0],)], "value string")
    found = _plan(lines.filter(ingest.is_json(F.col("value"))))
    assert found.index("from_json(") < found.index("regexp_replace(")  # the patterns come last


def test_new_rows_are_passed_on_as_they_are(spark):
    """The row of a key is that of ``classify_by_key``, of a hot key too, without an aggregate of whole rows."""
    from parcela.operators import load

    rows = [("hot" if i % 3 == 0 else None if i % 17 == 0 else f" R{i % 40} ", i % 5 if i % 4 else None, [f"x{i % 11}"]) for i in range(900)]
    batch = spark.createDataFrame(rows + rows[:50], "reference string, n int, v array<string>").repartition(5)
    target = spark.createDataFrame([("R1",), (" R2",), (None,), ("R2",)], "reference string")
    for order in (None, "n"):
        placed = load.classify_by_key(target, batch, order=order).filter(F.col("statut") == load.INSERTED)
        new = load.new_rows(target, batch, order=order)
        assert sorted(map(str, new.collect())) == sorted(map(str, placed.select("reference", "n", "v").collect()))
        assert new.columns == batch.columns and "min_by" not in _plan(new) and "WindowGroupLimit" in _plan(new)
