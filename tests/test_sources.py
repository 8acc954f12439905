from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tidemark.sources import readers, schemas, sinks
from tidemark.files import names
from tidemark.streaming.ingest import incremental_ingest

AS_OF = "2024-02-01 10:00:00"


def land(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_assets_with_missing_and_odd_numbers(spark, tmp_path):
    page = [
        {"id": "a", "symbol": "s", "market_cap": 12.0, "market_cap_rank": 3, "extra": 1},
        {"id": "b", "market_cap": 9007199254740993, "total_volume": 5},
    ]
    for text, multiline in ((json.dumps(page), False), (json.dumps(page, indent=2), True)):
        path = land(tmp_path, f"{multiline}.json", text)
        df = readers.read_assets(spark, path, AS_OF, multiline)
        assert df.columns == [*schemas.ASSET_COLUMNS, "ingested_at"]
        assert rows(df, "id", "market_cap", "market_cap_rank", "total_volume", "name") == [
            ("a", 12, 3, None, None),
            ("b", 9007199254740993, None, 5.0, None),
        ]
        assert df.first().ingested_at == dt.datetime(2024, 2, 1, 10)


def test_malformed_document_is_an_error(spark, tmp_path):
    path = land(tmp_path, "bad.json", '[{"id": "a"\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_assets(spark, path, AS_OF).collect()


def test_sentiment(spark, tmp_path):
    data = [
        {"value": "52", "value_classification": "Neutral", "timestamp": "1704067200"},
        {"value": "0", "value_classification": "Extreme Fear", "timestamp": "1704153599"},
    ]
    path = land(tmp_path, "s.json", json.dumps({"name": "x", "data": data}))
    out = readers.read_sentiment(spark, path, AS_OF)
    day = dt.date(2024, 1, 1)
    assert rows(out, "value", "value_classification", "timestamp_date") == [
        (0, "Extreme Fear", day),
        (52, "Neutral", day),
    ]


def test_global_defaults(spark, tmp_path):
    document = {
        "data": {
            "total_market_cap": {"usd": 5.5, "eur": 1},
            "total_volume": {"eur": 1},
            "market_cap_percentage": {"btc": 51.5},
            "markets": 7,
        }
    }
    got = readers.read_global(spark, land(tmp_path, "g.json", json.dumps(document)), AS_OF).first()
    assert (got.total_market_cap_usd, got.total_volume_usd) == (5.5, 0.0)
    assert (got.btc_dominance, got.eth_dominance, got.markets) == (51.5, 0.0, 7)
    assert (got.active_cryptocurrencies, got.market_cap_change_24h_pct) == (0, 0.0)
    assert got.snapshot_date == "2024-02-01"


def test_trending_defaults(spark, tmp_path):
    document = {
        "coins": [
            {"item": {"id": "a", "name": "A", "symbol": "s", "market_cap_rank": 4, "score": 0}},
            {"item": {"id": "b", "market_cap_rank": None}},
            {},
        ]
    }
    out = readers.read_trending(spark, land(tmp_path, "t.json", json.dumps(document)), AS_OF)
    assert rows(out, "coin_id", "name", "symbol", "market_cap_rank", "score") == [
        ("", "", "", None, None),
        ("a", "A", "s", 4, 0),
        ("b", "", "", None, None),
    ]


def test_categories(spark, tmp_path):
    good = land(tmp_path, "c.csv", "coin_id,category,subcategory\na,X,Y\nb,Z,\n")
    assert rows(readers.read_categories(spark, good)) == [("a", "X", "Y"), ("b", "Z", None)]
    other = land(tmp_path, "o.csv", "coin,category,subcategory\na,X,Y\n")
    with pytest.raises(Exception, match="header"):
        readers.read_categories(spark, other).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_categories(spark, str(tmp_path / "none.csv")).collect()


# --- sinks -------------------------------------------------------------------
def keyed(spark, *data):
    return spark.createDataFrame(list(data), "id string, at int, x string")


def test_replace(spark, folder):
    path = folder()
    sinks.replace_table(keyed(spark, ("a", 1, "old"), ("b", 1, "old")), path)
    assert rows(sinks.replace_table(keyed(spark, ("c", 1, "new")), path)) == [("c", 1, "new")]


def test_merge_keeps_the_newest_and_is_idempotent(spark, folder):
    path = folder()
    first = keyed(spark, ("a", 1, "old"), ("b", 5, "kept"), ("b", 4, "older"))
    second = keyed(spark, ("a", 2, "new"), ("b", 3, "late"), ("c", 1, "added"))
    for batch in (first, second, second):
        sinks.merge_latest(spark, path, batch, ["id"], "at")
    expected = [("a", 2, "new"), ("b", 5, "kept"), ("c", 1, "added")]
    assert rows(sinks.read_merged(spark, path)) == expected


def test_interrupted_merge_leaves_the_table(spark, folder):
    path = folder()
    sinks.merge_latest(spark, path, keyed(spark, ("a", 1, "old"), ("b", 1, "kept")), ["id"], "at")

    def broken(text):
        problem = F.raise_error(F.lit("lost")).cast("string")
        return keyed(spark, ("a", 2, text)).withColumn("x", F.when(F.col("at") > 1, problem))

    with pytest.raises(Exception, match="lost"):
        sinks.merge_latest(spark, path, broken("new"), ["id"], "at")
    assert rows(sinks.read_merged(spark, path)) == [("a", 1, "old"), ("b", 1, "kept")]
    # a write that ended before its marker
    unfinished = f"{path}/version=0000000009"
    keyed(spark, ("a", 9, "torn")).withColumn("bucket_of_16", F.lit(1)).write.partitionBy(
        "bucket_of_16"
    ).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(unfinished)
    assert rows(sinks.read_merged(spark, path)) == [("a", 1, "old"), ("b", 1, "kept")]
    sinks.merge_latest(spark, path, keyed(spark, ("a", 2, "new")), ["id"], "at")
    assert rows(sinks.read_merged(spark, path)) == [("a", 2, "new"), ("b", 1, "kept")]
    more = keyed(spark, ("c", 3, "more")).withColumn("y", F.lit(7))
    assert rows(sinks.merge_latest(spark, path, more, ["id"], "at")) == [
        ("a", 2, "new", None), ("b", 1, "kept", None), ("c", 3, "more", 7)
    ]


def test_merge_writes_only_the_buckets_it_touches(spark, folder):
    path = folder()
    many = spark.range(200).select(
        F.col("id").cast("string").alias("id"), F.lit(1).alias("at"), F.lit("old").alias("x")
    )
    sinks.merge_latest(spark, path, many, ["id"], "at", buckets=8)
    sinks.merge_latest(spark, path, keyed(spark, ("7", 2, "new")), ["id"], "at")
    table = sinks.read_merged(spark, path)
    assert table.count() == 200 and table.filter("x = 'new'").count() == 1
    written = [n for n in names(spark, f"{path}/version=0000000002") if n != "_SUCCESS"]
    assert len(written) == 1
    assert len(names(spark, f"{path}/version=0000000001")) == 9
    empty = keyed(spark, ("z", 1, "-")).limit(0)
    assert sinks.merge_latest(spark, path, empty, ["id"], "at").count() == 200
    assert len(names(spark, f"{path}/version=0000000001")) == 8


def series(spark, low, high, x, at=1):
    return spark.range(low, high).select(
        F.col("id").cast("int").alias("k"),
        F.concat(F.lit("long common prefix of every text key, "), F.format_string("%06d", "id")).alias("id"),
        F.lit(at).alias("at"),
        F.lit(x).alias("x"),
    )


@pytest.mark.parametrize("keys", [["k"], ["id"], ["k", "id"]])
def test_a_batch_in_a_key_range_rewrites_that_range(spark, folder, keys):
    """The files of all other ranges stay, a range that grows is split, and rows come out whole."""
    path = folder()

    def held():
        return {
            f"{v}/{r}/{f}"
            for v in names(spark, path)
            for r in names(spark, f"{path}/{v}") if r.startswith("range_from")
            for f in names(spark, f"{path}/{v}/{r}") if f.startswith("part-")
        }

    def merge(df):
        return sinks.merge_latest(spark, path, df, keys, "at", buckets=10, range_rows=300)

    merge(series(spark, 0, 2_000, "old"))
    before = held()
    table = merge(series(spark, 1_010, 1_050, "new", 2))
    assert table.count() == 2_000
    assert rows(table.where("x = 'new'").select("k")) == [(i,) for i in range(1_010, 1_050)]
    if keys != ["id"]:  # a text key is told by its first characters, which are all alike
        assert len(before) >= 10
        added = held() - before
        assert len(added) <= 2
        merge(series(spark, 0, 1, "newer", 3))  # what the last merge replaced goes with the next
        assert len(before - held()) <= 2
    # new keys at the end fill the last range until it is cut
    grown = merge(series(spark, 2_000, 6_000, "more"))
    assert grown.count() == 6_000
    assert grown.select(*keys).distinct().count() == 6_000
    if keys != ["id"]:
        assert len({n.split("/")[1] for n in held()}) > 15
    assert rows(merge(series(spark, 0, 6_000, "last", 9)).groupBy("x").count()) == [("last", 6_000)]


def test_ranges_of_any_key(spark, folder):
    """Keys of several types, with NULLs, in any order."""
    made = [
        (dt.date(2024, 1, 1 + i % 28) if i % 9 else None, i / 7 if i % 5 else None, i)
        for i in range(300)
    ]
    df = spark.createDataFrame(made, "d date, v double, at int")
    path = folder()
    for part in (df.where("at < 150"), df.where("at >= 100"), df.where("at % 2 = 0")):
        sinks.merge_latest(spark, path, part, ["d", "v"], "at", buckets=6, range_rows=40)
    whole = sinks.latest_per_key([df], ["d", "v"], "at")
    assert rows(sinks.read_merged(spark, path)) == rows(whole)


def test_replace_may_read_what_it_replaces(spark, folder):
    path = folder()
    table = sinks.replace_table(keyed(spark, ("a", 1, "x"), ("b", 2, "y")), path)
    assert rows(sinks.replace_table(table.filter("at = 2"), path)) == [("b", 2, "y")]


def test_merge_prefers_the_incoming_row_on_a_tie(spark):
    out = sinks.latest_per_key(
        [keyed(spark, ("a", 1, "stored")), keyed(spark, ("a", 1, "sent"))], ["id"], "at"
    )
    assert rows(out) == [("a", 1, "sent")]
    assert plan(out).count("WindowGroupLimit") == 2


def dated(spark, *data):
    return spark.createDataFrame(list(data), "id int, snapshot_date string").withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date")
    )


def test_append_retention_and_backfill(spark, folder):
    path = folder()
    sinks.append_snapshot(dated(spark, (1, "2024-01-01"), (2, "2024-01-02")), path)
    sinks.append_snapshot(dated(spark, (3, "2024-01-03")), path)
    table = spark.read.parquet(path)
    assert table.count() == 3
    kept = sinks.retained(table, "snapshot_date", 2, F.lit("2024-01-03").cast("date"))
    assert rows(kept, "id") == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan(kept)
    again = dated(spark, (10, "2024-01-01"), (20, "2024-01-02"), (30, "2024-01-03"))
    sinks.backfill(again, path, "snapshot_date", "2024-01-02", "2024-01-02")
    assert rows(spark.read.parquet(path), "id") == [(1,), (20,), (3,)]
    # a day that recomputes to nothing goes, a repeated snapshot stays single
    sinks.backfill(again.filter("id = 10"), path, "snapshot_date", "2024-01-01", "2024-01-02")
    sinks.append_snapshot(dated(spark, (3, "2024-01-03")), path)
    assert rows(spark.read.parquet(path), "id") == [(10,), (3,)]
    sinks.drop_expired(spark, path, "snapshot_date", 2, F.lit("2024-01-03").cast("date"))
    assert names(spark, path)[-1:] == ["snapshot_date=2024-01-03"]
    assert rows(spark.read.parquet(path), "id") == [(3,)]


def test_row_counts(spark):
    out = sinks.row_counts({"one": spark.range(1), "none": spark.range(0)})
    assert rows(out) == [("none", 0), ("one", 1)]


def test_incremental_ingest_takes_each_file_once(spark, folder):
    landing, target, progress = folder("landing"), folder("target"), folder("progress")
    schema = "id string, at int, x string"

    def run():
        incremental_ingest(spark, landing, schema, target, progress, ["id"], "at")
        return rows(sinks.read_merged(spark, target))

    keyed(spark, ("a", 1, "old"), ("b", 1, "one")).write.mode("append").json(landing)
    assert run() == [("a", 1, "old"), ("b", 1, "one")]
    keyed(spark, ("a", 2, "new")).write.mode("append").json(landing)
    assert run() == [("a", 2, "new"), ("b", 1, "one")]
    assert run() == [("a", 2, "new"), ("b", 1, "one")]


def test_a_response_without_data_stops_the_run(spark, folder):
    path = folder("failed")
    spark.createDataFrame([('{"status": {"error": "rate limit"}}',)], "value string").write.text(path)
    for read in (readers.read_sentiment, readers.read_global):
        with pytest.raises(Exception, match="response without 'data'"):
            read(spark, path).collect()
