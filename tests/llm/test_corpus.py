"""Stages of the corpus pipeline on small tables."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from wakeline.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(spark, rows):
    """Rows of (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("chunk_rows", [mixing.CHUNK_ROWS, 100])
def test_mixture_meets_targets(spark, monkeypatch, chunk_rows):
    """Each source leaves the stage with its target of words, also those that shrink."""
    monkeypatch.setattr(mixing.copies, "__defaults__", (chunk_rows, 11))
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(1, 900)), f"s{i % 5}") for i in range(600)]
    rows += [(None, "w " * 300, "s2")] * 40 + [(7, "w " * 200, "s2"), (8, None, "s2"), (9, "", None)]
    docs = texts(spark, rows)
    target = {r.source: r.target for r in mixing.taken(mixing.mix(docs)).collect()}
    got = Counter()
    for row in corpus_pipeline.mixture(spark, docs, "").collect():
        got[row.source] += len(row.text.split())
    sizes, longest = Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
        longest[source] = max(longest[source], len((text or "").split()))
    chunks = -(-len(rows) // chunk_rows)
    assert min(target[s] / sizes[s] for s in "s0 s1 s2 s3 s4".split()) < 0.6
    for source in "s0 s1 s2 s3 s4".split():
        assert abs(got[source] - target[source]) <= chunks * longest[source] + 2 * mixing.BLOCK
    assert None not in got
    assert corpus_pipeline.mixture(spark, texts(spark, []), "").count() == 0


def test_copies_have_no_bias(spark):
    """Over several keys, short and long documents are drawn as often as their words are taken."""
    rows = [(i, "w " * (5 if i % 2 else 500), f"s{i % 3}") for i in range(900)]
    plan = mixing.mix(texts(spark, rows))
    size = {r["_order"]: r["size"] for r in plan.sizes.collect()}
    drawn, taken = Counter(), Counter()
    for seed in range(4):
        for row in mixing.copies(plan, seed=seed).collect():
            drawn[size[row["_order"]]] += row.times
    for row in mixing.taken(plan).collect():
        taken[row["size"]] += row.taken
    for n in (5, 500):
        assert abs(drawn[n] / 4 - taken[n] / n) <= 4


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, groups without ids, and an id shared by a copy and a text of its own."""
    rng = random.Random(9)
    one, two, three, four, five = (" ".join(str(rng.randint(0, 10**6)) for _ in range(40)) for _ in range(5))
    rows = [(1, one, "s")] * 3 + [(None, two, "s")] * 2 + [(None, f"{two} more", "t"), (None, three, "s")]
    rows += [(5, four, "s"), (6, four, "s"), (6, five, "s"), (None, four, "s"), (8, "", "s"), (9, None, "s")]
    got = corpus_pipeline.near_duplicates(spark, texts(spark, rows).repartition(3), "")
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert [t for i, t in kept if t and t.startswith(two)] in ([two], [f"{two} more"])
    rest = Counter(x for x in kept if not (x[1] or "").startswith(two))
    assert rest == Counter([(1, one), (None, three), (5, four), (6, five), (8, ""), (9, None)])
    assert corpus_pipeline.near_duplicates(spark, texts(spark, []), "").count() == 0


LANGUAGES = {"aa": "abcdefgh", "bb": "mnopqrst", "cc": "uvwxyzäö"}


def spoken(rng, lang, count=40):
    return " ".join("".join(rng.choices(LANGUAGES[lang], k=rng.randint(2, 7))) for _ in range(count))


def test_language_judges_each_row(spark):
    """Junk goes and texts stay, also where they share an id or have none."""
    rng = random.Random(1)
    rows = [(i, spoken(rng, lang), lang, "s", 0) for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    good = [(500, spoken(rng, "aa"), None, "s", 0), (None, spoken(rng, "bb"), None, "s", 0)] * 2
    junk = [(500, "!!", "aa", "s", 0), (None, "12 34", "bb", "s", 0), (600, None, "aa", "s", 0), (601, "", None, "s", 0)]
    docs = spark.createDataFrame(rows + good + junk, SCHEMA).repartition(4)
    got = Counter(tuple(r) for r in corpus_pipeline.language(spark, docs, "").collect())
    assert got == Counter(rows + good)
    assert corpus_pipeline.language(spark, docs, "").columns == list(corpus_pipeline.COLUMNS)
    assert corpus_pipeline.language(spark, docs.filter("false"), "").count() == 0


def test_decontamination_judges_each_row(spark, tmp_path):
    rng = random.Random(2)
    item = spoken(rng, "aa", 30)
    spark.createDataFrame([(1, item, 7)], "item_id long, text string, n_chars int").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    good, bad = spoken(rng, "bb"), f"{spoken(rng, 'cc', 9)} {item}"
    rows = [(1, good, "s"), (1, bad, "s"), (None, good, "s"), (None, bad, "s"), (2, None, "s"), (3, "", "t")]
    docs = texts(spark, rows + rows)
    got = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert got.columns == list(corpus_pipeline.COLUMNS)
    assert Counter((r.doc_id, r.text, r.source) for r in got.collect()) == Counter(
        2 * [x for x in rows if x[1] != bad]
    )
    assert corpus_pipeline.decontamination(spark, texts(spark, []), str(tmp_path)).count() == 0


def test_run_chains_all_stages(spark, tmp_path):
    """Clean rows come through; junk, a near copy and a leak do not."""
    rng = random.Random(3)
    item = spoken(rng, "bb", 25)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = [(i, spoken(rng, lang), lang, "s", 0) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    copy = (100, f"{kept[4][1]} {spoken(rng, 'bb', 1)}", "bb", "s", 0)
    gone = [(101, f"{item} {spoken(rng, 'bb', 9)}", "bb", "s", 0), (102, "?? 5", "aa", "s", 0), (103, None, None, None, 0)]
    spark.createDataFrame([*kept, copy, *gone], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(set(r.doc_id for r in got)) == list(range(60))
    assert sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
