"""The pipeline, stage by stage, against brute force on a small table."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from churnlens.llm import components, minhash, packing, quality_rules, substring_dedup
from churnlens.llm.common import save

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(seed, n):
    rng = random.Random(seed)
    words = ("the", "and", "of", "to", "in")
    return " ".join(rng.choice(words) if rng.random() < 0.25 else "".join(
        rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 9))) for _ in range(n))


BASE = _prose(77, 60)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    passage = _prose(900, 80)
    rows = [(i, _prose(i, 60 + i), "en", "s", 1) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s", 1) for i in range(5)]
    rows += [(200 + i, rows[i][1] + " more", None, "s", 1) for i in range(5, 8)]
    rows += [(300 + i, _prose(500 + i, 50) + "\n" + passage, "en", None, 1) for i in range(4)]
    rows += [(400 + i, "#$% " * 60 + _prose(700 + i, 40), "en", "s", 1) for i in range(20)]
    rows += [(500, None, "en", "s", 0), (501, "", "en", "s", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{at}/documents.parquet")
    labels = [(r[0], int(r[0] < 400), 0) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{at}/labels.parquet")
    return at


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "quality classifier", "minhash near-dedup",
                     "substring dedup", "best-fit packing"]
    rules, classifier, near, cut, pack = [f for _, f in corpus_pipeline.STAGES]

    kept = save(rules(spark, docs, sf_dir), "t")
    good = {r["doc_id"] for r in quality_rules.judge(docs).where("kept").collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == good
    assert good == {r["doc_id"] for r in docs.collect()} - {500, 501} - set(range(400, 420))

    # only one class is left, so nothing else may go
    scored = save(classifier(spark, kept, sf_dir), "t")
    assert scored.columns == docs.columns and scored.count() == kept.count()

    one = save(near(spark, scored, sf_dir), "t")
    texts = {r["doc_id"]: r["text"] for r in scored.collect()}
    sets = {i: minhash.shingle_set(t) for i, t in texts.items()}
    gone = {b for a in sets for b in sets if a < b and minhash.linked(sets[a], sets[b])}
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == set(sets) - gone
    assert gone >= {100, 101, 102, 103, 104, 205, 206, 207}

    short = save(cut(spark, one, sf_dir), "t")
    texts = {r["doc_id"]: r["text"] for r in one.collect()}
    holders = {}
    for i, t in texts.items():
        for d in substring_dedup.chunks(t)[2]:
            holders.setdefault(d, set()).add(i)
    want = {i: substring_dedup.cut_runs(
        t, {d: min(h) for d, h in holders.items() if len(h) > 1 and min(h) != i}, 20)[0]
        for i, t in texts.items()}
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in short.collect()}
    assert got == {i: (t, len(t)) for i, t in want.items() if t.strip()}
    assert short.columns == docs.columns and sum(want[300 + i] != texts[300 + i] for i in range(4)) == 3

    packed = pack(spark, short, sf_dir).collect()
    encoder = packing.Encoder(packing.tokenizer_path())
    assert Counter((r["doc_id"], r["length"]) for r in packed) == Counter(
        (i, length) for i, (t, _) in got.items()
        for _, length in packing.pieces_of(len(encoder.ids(t)) + 1))


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns[0] == "doc_id" and out.count() > 0
    assert not {r["doc_id"] for r in out.collect()} & {400, 500, 501, 100, 205}


def test_near_copies_between_80_and_85_go(spark, sf_dir):
    rows = []
    for i in range(150):
        words = _prose(2000 + i, 100).split()
        # 96 shingles, a changed word inside takes five of them; one at the end takes one
        changed = [*words[:30], f"x{i}", *words[31:60], f"y{i}", *words[61:]]
        rows += [(2 * i, " ".join(words), "en", "s", 1), (2 * i + 1, " ".join(changed), "en", "s", 1)]
    rows.append((1000, " ".join(_prose(2000, 100).split()[:30] + _prose(1, 70).split()), "en", "s", 1))
    sets = {r[0]: minhash.shingle_set(r[1]) for r in rows}
    links = {b for a in sets for b in sets if a < b and minhash.linked(sets[a], sets[b], 80)}
    assert links == set(range(1, 300, 2))
    assert not any(minhash.linked(sets[i], sets[i + 1], 85) for i in range(0, 300, 2))
    near = dict(corpus_pipeline.STAGES)["minhash near-dedup"]
    left = near(spark, spark.createDataFrame(rows, DOCS), sf_dir)
    assert {r["doc_id"] for r in left.collect()} == set(sets) - links


def test_bands_follow_the_threshold():
    assert [minhash.band_plan(p) for p in (80, 85, 95)] == [(48, 7), (32, 8), (32, 8)]
    for pct in (60, 70, 80, 85, 90, 99):
        bands, rows = minhash.band_plan(pct)
        assert (1 - (pct / 100) ** rows) ** bands <= 4e-5
    with pytest.raises(ValueError):
        minhash.band_plan(5)


def test_one_of_equal_rows_stays(spark):
    rows = [(1, BASE, "a"), (1, BASE, "a"), (1, BASE, "b"), (1, "other words of one id", "a"),
            (2, BASE, "a"), (3, "alone", "a"), (None, BASE, "a"), (None, BASE, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = [(r["doc_id"], r["text"]) for r in minhash.keep_one(docs, pct=80).collect()]
    assert sorted(got, key=str) == sorted([(1, BASE), (1, "other words of one id"), (3, "alone"),
                                           (None, BASE), (None, BASE)], key=str)


@pytest.mark.parametrize("order", ["ascending", "descending", "random"])
def test_chains_take_few_rounds(spark, monkeypatch, order):
    ids = list(range(2000))
    if order == "descending":
        ids.reverse()
    if order == "random":
        random.Random(4).shuffle(ids)
    chain = list(zip(ids, ids[1:], strict=False))
    rounds = []
    save = components.save
    monkeypatch.setattr(components, "save", lambda df, label: rounds.append(label) or save(df, label))
    edges = spark.createDataFrame([*chain, (5000, 5001), (5001, 5001), (None, 3)], "a long, b long")
    got = {r["v"]: r["component"] for r in components.components(edges, "a", "b").collect()}
    assert got == {**dict.fromkeys(range(2000), 0), 5000: 5000, 5001: 5000}
    assert rounds.count("edges") - 1 <= 15 and len(rounds) <= 60
