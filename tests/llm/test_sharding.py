import hashlib
import zlib

import pandas as pd

from riskmart.llm import sharding


def brute(docs: pd.DataFrame, count: int, seed: int) -> pd.DataFrame:
    rows = docs.assign(
        key=docs.source.map(lambda s: "n" if s is None else f"s{s}"), text=docs.text.map(lambda t: (t or "").encode()),
        h=docs.doc_id.map(lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest()),
    )
    rows = rows.sort_values(["key", "h", "doc_id"])
    rows["rank"], rows["n"] = rows.groupby("key").cumcount() + 1, rows.groupby("key").doc_id.transform("size")
    shift = rows.key.map(lambda k: (int(hashlib.md5(k.encode()).hexdigest()[:8], 16) + 0.5) / 2.0**32)
    rows["frac"] = (rows["rank"] - shift) / rows.n
    rows = rows.sort_values(["frac", "key", "h", "doc_id"]).reset_index(drop=True)
    rows["shard"] = [i * count // len(rows) for i in range(len(rows))]
    rows["slot"] = rows.groupby("shard").cumcount()
    rows["size"], rows["crc"] = rows.text.map(len) + 1, rows.text.map(zlib.crc32)
    return rows


def documents(spark, n=700):
    data = [(i, None if i % 97 == 0 else "" if i % 89 == 0 else f"té{i % 50} x" * (i % 7), None if i % 31 == 0 else "hot" if i % 3 == 0 else f"s{i % 9}" if i % 2 else f"one{i}") for i in range(n)]
    return spark.createDataFrame(data, "doc_id long, text string, source string")


def test_equals_brute_force(spark):
    df = documents(spark).withColumn("cut", df_lit()).withColumn("shard", df_lit())  # clashing names
    got = sharding.shards(df, 16, 17).toPandas().sort_values("doc_id")
    want = brute(documents(spark).toPandas(), 16, 17).sort_values("doc_id")
    for mine, theirs in (("size", "size"), ("text_crc32", "crc"), ("shard", "shard"), ("slot", "slot")):
        assert got[mine].tolist() == want[theirs].tolist(), mine


def df_lit():
    from pyspark.sql import functions as F

    return F.lit(5)


def test_law_and_mixture(spark):
    df = documents(spark).where("source is null or source not like 'one%'")
    got = sharding.shards(df).join(df, "doc_id").toPandas()
    sizes = got.groupby("shard").size()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 1 and set(got.law) == {"rows"}
    for _, rows in got.groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))
    hot = got[got.source == "hot"].groupby("shard").size()
    assert hot.max() - hot.min() <= 3
    assert got.grown_shard.isna().all()


def test_repeated_rows_and_empty(spark):
    df = documents(spark, 40)
    got = sharding.shards(df.union(df).union(df)).toPandas()
    assert len(got) == 120 and len(got.drop_duplicates(["shard", "slot"])) == 120
    assert sharding.shards(df.where("false")).count() == 0
