"""A third of all rows equal, or near copies of one page: work is dealt evenly and grows in proportion."""

import random

from helpers import classes, contamination, cut, spaced
from pyspark.sql import functions as F

from cardamom.llm import decontaminate as D
from cardamom.llm import near_dedup as N
from cardamom.llm.common import row_places
from cardamom.llm.substring_dedup import dedup_substrings
from cardamom.llm.warc import page_records, read_archives, resolve, write_archives
from cardamom.session import shared_dir


def stored(spark, rows, schema, files=3):
    path = shared_dir(spark, "rows")
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def prose(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_equal_rows_of_a_stored_table_are_told_apart(spark):
    rng = random.Random(1)
    same = prose(rng, 80)
    rows = [(5, same)] * 600 + [(100 + i, prose(rng, 30)) for i in range(1200)]
    docs = stored(spark, rows, "doc_id long, text string")
    places = row_places(docs)
    assert docs.select(F.xxhash64(*places)).distinct().count() == 1800
    assert row_places(docs.where("doc_id = 5")) and not row_places(spark.createDataFrame(rows[:3], "doc_id long, text string"))
    dealt = docs.groupBy(F.pmod(F.xxhash64("doc_id", "text", *places), F.lit(12))).count().select("count").collect()
    sizes = sorted(r[0] for r in dealt)
    assert len(sizes) == 12 and sizes[-1] < 2 * sizes[6]


def test_substrings_with_a_third_of_all_rows_equal(spark):
    rng = random.Random(2)
    same = prose(rng, 40)
    rows = [(50, same)] * 100 + [(i, f"{prose(rng, 10)} {same} end") for i in (3, 70, 71)] + [(100 + i, prose(rng, 40)) for i in range(200)]
    docs = stored(spark, rows, "doc_id long, text string")
    found = dedup_substrings(docs, window=20, chunk_bytes=1 << 11).selectExpr("doc.doc_id", "n_words", "n_removed", "text").collect()
    assert sorted((r[0], r[1], r[2], " ".join(spaced(r[3]))) for r in found) == sorted(cut(rows, 20))


def test_equal_pages_are_records_of_their_own(spark):
    body = "z" * 200
    pages = stored(spark, [(1, "u", body)] * 60 + [(2 + i, f"u{i}", f"{i} " * 80) for i in range(120)], "page_id long, url string, html string")
    records = page_records(pages)
    assert records.select("record_id").distinct().count() == 180
    path = shared_dir(spark, "warc")
    write_archives(records, path, file_bytes=4000)
    read = read_archives(spark, path)
    assert read.select("record_id").distinct().count() == 180
    files = sorted(r[0] for r in spark.read.format("binaryFile").load(path).select("path", "length").where("length > 100").select("length").collect())
    assert len(files) > 4
    assert resolve(read).where("page_id = 1 and record_type = 'response'").count() == 60


def test_a_large_benchmark_sends_only_shingles_it_may_have(spark, monkeypatch):
    rng = random.Random(3)
    items = [(i, prose(rng, 40)) for i in range(8)]
    docs = [(i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(300))) for i in range(120)]
    docs[7] = (7, f"{docs[7][1]} {items[2][1]}")
    docs += [(200, items[3][1])] * 60  # equal rows
    sent = []

    def counted(df, label):
        out = real(df, label)
        sent.append(out.count())
        return out

    real = D.written
    monkeypatch.setattr(D, "written", counted)
    tables = stored(spark, docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = D.decontaminate(*tables, broadcast_words=0).select("doc.doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert sorted(tuple(r) for r in got) == sorted(contamination(docs, items))
    # 61 texts hold about 38 shingles of the benchmark each; the other 36,000 shingles stay where they are.
    assert sent == [61 * 38]


def near_copies(rng, n):
    """Texts that differ from one page in so many words that some pairs are links and some are not."""
    base = [f"b{k}" for k in range(200)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            words[rng.randrange(len(words))] = f"n{i}x{rng.randrange(1000)}"
        out.append((i, " ".join(words)))
    return out


def test_near_copies_of_a_page_do_not_name_all_their_pairs(spark, monkeypatch):
    named = []
    real = N._links

    def counted(pairs, *rest):
        named[-1] += pairs.count()
        return real(pairs, *rest)

    monkeypatch.setattr(N, "_links", counted)
    monkeypatch.setattr(N, "BLOCK", 64)
    for n in (60, 240):
        named.append(0)
        docs = near_copies(random.Random(n), n)
        found = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
        assert {r.doc_id: r.class_id for r in found.collect()} == classes(docs)
    assert named[1] < 8 * named[0]  # four times the copies; all pairs would be sixteen times as many
