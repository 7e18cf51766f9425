import random

import pytest
from helpers import classes, contamination, cut, spaced

import corpus_pipeline
from cardamom.llm import pipeline as P
from cardamom.session import shared_dir


@pytest.fixture(scope="module")
def corpus():
    """Documents with planted cases, labels, benchmark items."""
    rng = random.Random(21)
    syllables = ["ba", "ko", "mi", "tu", "re", "sa", "no", "li", "ve", "da"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randint(14, 30))) for i in range(6)]
    docs = [(i, prose(rng.randint(20, 160))) for i in range(240)]
    for i in range(0, 240, 4):  # toxic, in different places
        words = docs[i][1].split()
        for _ in range(2 + len(words) // 20):
            words.insert(rng.randrange(len(words)), rng.choice(["grunk", "zarf", "Gr0nk"]))
        docs[i] = (i, " ".join(words))
    toxic = {i for i in range(0, 240, 4)}
    passage = prose(60)
    for i in (9, 41, 77):  # a shared passage
        docs[i] = (i, f"{docs[i][1]}\n{passage} {prose(30)}")
    for i, item in ((13, 0), (17, 1)):
        docs[i] = (i, f"{prose(10)} {items[item][1]} {prose(10)}")
    docs.append((300, docs[21][1].upper()))
    words = prose(200).split()
    docs += [(301, " ".join(words)), (302, " ".join([*words[:100], "other", *words[101:]]))]
    docs += [(400, None), (401, ""), (402, "...")]
    labels = [(i, 1, int(i in toxic)) for i, _ in docs if i < 240]
    return docs, labels, items


def stored(spark, corpus):
    docs, labels, items = corpus
    path = shared_dir(spark, "tables")
    rows = [(i, t, "xx", "s", None if t is None else len(t), "extra") for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_against_a_plain_version(spark, corpus):
    docs, labels, items = corpus
    path = stored(spark, corpus)
    frame = spark.read.parquet(f"{path}/documents.parquet")
    columns = frame.columns
    found = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, path)
        if k < 4:
            assert frame.columns == columns
            frame.write.parquet(f"{path}/{name}")
            frame = spark.read.parquet(f"{path}/{name}")
            found.append({r.doc_id: r for r in frame.collect()})
    toxic = {i for i, _, t in labels if t}
    kept = {i: t for i, t in docs if i not in toxic}
    assert {i: r.text for i, r in found[0].items()} == kept
    of = classes(list(kept.items()))
    kept = {i: t for i, t in kept.items() if of[i] == i}
    assert 300 not in kept and 302 not in kept and set(found[1]) == set(kept)
    cutted = {i: (n, gone, left) for i, n, gone, left in cut(list(kept.items()), 50)}
    assert {i for i, (_, gone, _) in cutted.items() if gone} == {41, 77}
    for i, r in found[2].items():
        assert " ".join(spaced(r.text)) == cutted[i][2]
        assert r.n_chars == (None if r.text is None else len(r.text))
        assert cutted[i][1] or r.text == kept[i]
    kept = {i: r.text for i, r in found[2].items()}
    bad = {x[0] for x in contamination(list(kept.items()), items) if x[4]}
    assert bad == {13, 17} and set(found[3]) == set(kept) - bad
    lengths = {}
    for r in frame.collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {i: len(spaced(kept[i])) for i in kept if i not in bad and spaced(kept[i])}
    again = sorted((r.doc_id, r.length) for r in corpus_pipeline.run(spark, path).collect())
    assert again == sorted(lengths.items())


def test_stages_on_odd_rows(spark, corpus):
    path = stored(spark, corpus)
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six"), (2, None), (3, ""), (4, "ONE two three four five six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "doc_id", "1 as class_id", "2 as rep")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        none = stage(spark, docs.where("false"), path)
        assert none.columns == docs.columns and none.count() == 0
    kept = corpus_pipeline.keep_one_of_each_class(spark, docs, path)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, rows[0][1]), (2, None), (3, "")], key=repr)
    assert corpus_pipeline.drop_toxic(spark, docs, path).count() == len(rows)
    assert corpus_pipeline.cut_repeated_passages(spark, docs, path).count() == len(rows)
    assert corpus_pipeline.drop_contaminated(spark, docs, path).count() == len(rows)
    packed = corpus_pipeline.pack_sequences(spark, docs, path)
    assert packed.agg({"length": "sum"}).first()[0] == 24 and packed.where("doc_id in (2, 3)").isEmpty()
    assert corpus_pipeline.pack_sequences(spark, docs.where("false"), path).isEmpty()


@pytest.mark.parametrize("top", [50, 2**63 - 1])
def test_texts_of_repeated_ids_are_told_apart(spark, corpus, top):
    words = lambda x: " ".join(f"{x}{k}" for k in range(40))
    rows = [(1, words("a")), (2, words("a")), (2, words("clean")), (3, words("x")), (3, words("y")), (3, words("x")), (None, words("z")), (None, words("z")), (None, words("y")), (None, None), (top, words("top"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each_class(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert sorted({t for _, t in rows}, key=repr) == sorted((t for _, t in got), key=repr)
    assert {(1, words("a")), (2, words("clean")), (top, words("top"))} <= set(got)
    nodes = [r._node for r in P.with_own_ids(docs).collect()]
    assert len(nodes) == len(set(nodes)) and None not in nodes


def test_stages_on_a_very_long_text(spark, corpus):
    path = stored(spark, corpus)
    long = " ".join(f"w{k}" for k in range(400_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "short one")], "doc_id long, text string")
    kept = [3, 2, 2, 2]
    for n, (_, stage) in zip(kept, corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, path)
        assert docs.count() == n
    assert corpus_pipeline.pack_sequences(spark, docs, path).agg({"length": "sum"}).first()[0] == 400_002
