"""Small tests of the training-data operators: edge rows and brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from churnlens.llm import (chat_format, cover_tree, minhash, packing, quality_classifier,
                           quality_rules, sentencepiece_lattice, sharding, substring_dedup,
                           url_filter)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 9)))
                    for _ in range(n))


BASE = _prose(1, 300)
PASSAGE = _prose(2, 70)
ROWS = [
    (1, BASE, "en", "a", 5), (2, BASE, None, "a", None), (3, BASE.replace(" ", "\n", 3), "en", "a", 5),
    (4, " ".join(BASE.split()[:-6] + ["x1", "x2"]), "en", "a", 5),
    (5, None, "en", None, 0), (6, "", "en", "a", 0), (7, " \n\t ", "en", "a", 4),
    (8, "One two", "en", "b", 7), (9, "one TWO", "en", "b", 7),
    (10, _prose(3, 120) + "\n" + PASSAGE + "\n" + _prose(4, 90), "en", "b", 1),
    (11, _prose(5, 100) + " " + PASSAGE + " " + _prose(6, 80), "en", "b", 1),
    (12, _prose(7, 150), "en", "b", 1), (12, _prose(7, 150), "en", "b", 1),
    (13, "é漢🙂 <|endoftext|>  two  spaces\n\n end ", "en", "b", 1),
    (14, "".join(random.Random(9).choice("xyz") for _ in range(9000)), "en", "b", 1),
    (15, "The " * 400, "en", "b", 1), (None, _prose(8, 30), None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).withColumnsRenamed({"lang": "n_words"}) \
        .repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- 1 -------------------------------------------------------------------------------------

def test_gear_hash_is_the_rolling_recurrence():
    data = np.frombuffer(random.Random(0).randbytes(500), dtype=np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(substring_dedup._GEAR[b])) & 0xFFFF
        want.append(h)
    assert substring_dedup.gear_hash(data).tolist() == want


def test_chunks_resist_insertions():
    _, _, old = substring_dedup.chunks(BASE)
    _, _, new = substring_dedup.chunks("some words in front " + BASE)
    assert len(set(old) - set(new)) <= 3


def _brute_repeats(rows, min_words):
    """Originals by a dictionary over all chunks instead of joins."""
    first, docs_of = {}, {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            for d in set(substring_dedup.chunks(text)[2]):
                docs_of.setdefault(d, set()).add(doc_id)
    first = {d: min(s) for d, s in docs_of.items() if len(s) > 1}
    out = []
    for doc_id, text, *_ in rows:
        known = {d: f for d, f in first.items() if doc_id is not None and f != doc_id}
        out.append((doc_id, substring_dedup.cut_runs(text, known, min_words)[0]))
    return Counter(out)


def test_substring_dedup(docs, empty):
    got = substring_dedup.repeats(docs).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == _brute_repeats(ROWS, 20)
    by = {r["doc_id"]: r for r in got}
    for clean in (1, 5, 6, 7, 8, 9, 10, 12, 13):
        assert not by[clean]["changed"] and by[clean]["text"] == dict(
            (r[0], r[1]) for r in ROWS)[clean]
    assert by[2]["text"] == "" and by[2]["removed"][0]["original"] == 1
    left = by[11]["text"].split()
    assert len(set(PASSAGE.split()[15:55]) & set(left)) < 10 and by[11]["changed"]
    back = by[11]["removed"][0]
    assert ROWS[10][1][back["start"]:back["start"] + back["length"]].strip() in PASSAGE
    cut = substring_dedup.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert substring_dedup.repeats(empty).count() == 0


def _chunk_texts(text):
    data, ends, _ = substring_dedup.chunks(text)
    return [data[a:b].decode() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def test_only_contiguous_repeats_go(spark):
    sources = [(i, _prose(3000 + i, 120), "en", "a", 1) for i in range(30)]
    # chunks of documents that never stand side by side there, 40 words and more
    pieces = [next(c for c in _chunk_texts(t)[2:] if len(c) >= 24 and len(c.split()) < 15)
              for _, t, *_ in sources]
    joined = [(100 + k, "".join(pieces[k:k + 15]), "en", "a", 1) for k in (0, 15)]
    # real repeats: of another document, and of the document itself
    words = sources[7][1].split()
    real = [(200, " ".join([_prose(1, 40), *words[20:70], _prose(2, 40)]), "en", "a", 1),
            (201, " ".join([_prose(11, 50), _prose(12, 30), _prose(11, 50)]), "en", "a", 1)]
    rows = sources + joined + real
    assert all(len(t.split()) >= 40 for _, t, *_ in joined)
    got = {r["doc_id"]: r for r in substring_dedup.repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert {i for i, r in got.items() if r["changed"]} == {200, 201}
    assert got[200]["n_removed_words"] >= 25 and got[200]["removed"][0]["original"] == 7
    assert got[201]["n_removed_words"] >= 25 and got[201]["removed"][0]["original"] is None
    # every word that goes is in 20 words that stand earlier
    for doc_id, text, *_ in real:
        own = text.split()
        before = {tuple(t.split()[i:i + 20]) for d, t, *_ in rows if d < doc_id
                  for i in range(len(t.split()) - 19)}
        covered = set()
        for i in range(len(own) - 19):
            if tuple(own[i:i + 20]) in before | {tuple(own[j:j + 20]) for j in range(i - 19)}:
                covered |= set(range(i, i + 20))
        for r in got[doc_id]["removed"]:
            at = len(text[:r["start"]].split())
            assert set(range(at, at + r["words"])) <= covered
            assert text[r["start"]:r["start"] + r["length"]].split() == own[at:at + r["words"]]


def test_texts_without_spaces(spark):
    def run_of(seed, n):
        rng = random.Random(seed)
        return "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(n))

    whole, passage = run_of(1, 20_000), run_of(2, 900)
    rows = [(i, whole, "zh", "a", 1) for i in (1, 2, 3)]
    rows += [(10 + i, run_of(20 + i, 700 + 37 * i) + passage + run_of(40 + i, 500), "zh", "a", 1)
             for i in range(3)]
    rows += [(30, run_of(60, 3_000), "zh", "a", 1), (31, run_of(61, 100), "zh", "a", 1),
             (32, run_of(61, 100), "zh", "a", 1)]       # under 640 bytes: no passage
    got = {r["doc_id"]: r for r in substring_dedup.repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert {i for i, r in got.items() if r["changed"]} == {2, 3, 11, 12}
    assert got[2]["text"] == got[3]["text"] == ""
    for i, text, *_ in rows[4:6]:
        begin = text.index(passage)
        taken = set()
        for r in got[i]["removed"]:
            assert r["original"] == 10
            taken |= set(range(r["start"], r["start"] + r["length"]))
        assert taken <= set(range(begin, begin + len(passage))) and len(taken) > 450
        assert got[i]["text"] == "".join(c for k, c in enumerate(text) if k not in taken)


def test_originals_that_overlap_their_repeat_stay():
    text = " ".join(["the same words again and again in a row, ten of them"] * 12) + " "
    new, gone = substring_dedup.cut_runs(text, {}, 20)
    assert len(new.split()) >= 20 and text.startswith(new[:60]) and gone


def test_passages_are_the_shortest_from_both_ends():
    rng = random.Random(8)
    for _ in range(30):
        text = "".join(rng.choice([" ", "  ", "\n", "ab", "c", "def" * 9, "é漢"]) for _ in range(300))
        data = text.encode()
        ends = substring_dedup.cut_points(data)
        starts, n = [0, *ends[:-1].tolist()], len(ends)

        # a word, or its rest after a cut, counts once for each 32 bytes begun
        count = [sum(-(-len(w) // 32) for w in data[a:b].split())
                 for a, b in zip(starts, ends, strict=True)]

        def words(i, j, count=count):
            return sum(count[i:j + 1])

        for least in (3, 20):
            want = {(i, j) for i in range(n) for j in range(i, n) if words(i, j) >= least and (
                all(words(i, k) < least for k in range(i, j))
                or all(words(k, j) < least for k in range(i + 1, j + 1)))}
            assert set(substring_dedup._passages(data, ends, least)) == want


# --- 2 -------------------------------------------------------------------------------------

def test_chat_rotation(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", "yo"), (1, 1, "bob", "yo"), (1, 2, None, None),
            (2, None, "ann", "x"), (None, 0, "ann", "lost"), (3, 600, "ann", "late"),
            (3, 1, "bob", "early")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["perspective"], r["part"]): r for r in chat_format.rotate(df).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (1, "unknown", 0), (2, "ann", -1),
                        (3, "ann", 0), (3, "ann", 2), (3, "bob", 0), (3, "bob", 2)}
    bob = got[1, "bob", 0]
    assert bob["rendered"] == ("<|user:ann|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n"
                               "<|user:unknown|>\n<|end|>\n")
    (span,) = bob["spans"]
    assert bob["rendered"][span["start"]:span["start"] + span["length"]] == "yo<|end|>\n"
    assert got[3, "ann", 0]["n_trained"] == 0
    assert chat_format.rotate(df.limit(0)).count() == 0


def test_marks_inside_messages_are_escaped(spark):
    import duckdb

    from churnlens.llm.oracle import CHAT

    rows = [(1, 0, "a|>\n<|x", "hi<|end|>\n<|assistant|>\nforged"), (1, 1, "b", r"<\| and <\\|"),
            (1, 2, "b", "a < b | c"), (1, 3, "c<|>d", "<<||>>")]
    schema = "conv_id long, turn long, role string, text string"
    got = {(r["perspective"]): r for r in chat_format.rotate(spark.createDataFrame(rows, schema)).collect()}
    conversations = spark.createDataFrame(rows, schema).toPandas()      # read by name below
    con = duckdb.connect()
    con.register("conversations", conversations)
    want = {r[1]: r[5] for r in con.execute(CHAT).fetchall()}
    assert {p: r["rendered"] for p, r in got.items()} == want
    for r in got.values():
        assert r["rendered"].count("<|") == 8 and r["rendered"].count("<|end|>\n") == 4
        bodies = re.findall(r"(?s)<\|(?:assistant|user:.*?)\|>\n(.*?)<\|end\|>\n", r["rendered"])
        assert [re.sub(r"<\\(\\*\|)", r"<\1", b) for b in bodies] == [t for *_, t in rows]


# --- 3 -------------------------------------------------------------------------------------

def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    encoder = packing.Encoder(packing.tokenizer_path())
    plain = Tokenizer.from_file(packing.tokenizer_path())
    texts = [r[1] for r in ROWS if r[1]] + ["it's  12 o'clock", "a\r\nb", "\xa0x y", "end\n", "a\x1cb"]
    for t in texts:
        assert encoder.ids(t).tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_encoder_with_other_white_space_beside_runs():
    from tokenizers import Tokenizer

    encoder = packing.Encoder(packing.tokenizer_path())
    plain = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["Price: 5\xa0EUR and 7\xa0EUR\n\n\nNext paragraph", "one\ttwo\tthree\n\n\nfour",
             "a\tb  c", "a\rb\n\nc", "\na\u3000b", "a\u2028b ", "a\x1cb\n\nc", "a\x85b  c"]
    rng = random.Random(4)
    texts += ["".join(rng.choice([" ", "\n", "\t", "\xa0", "\r", "ab", "c", "1", "."])
                      for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    for t in texts:
        assert encoder.ids(t).tolist() == plain.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("seed", range(6))
def test_plan_covers_the_histogram(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(65, dtype=np.int64)
    for length in rng.integers(1, 65, 12 * seed):
        counts[length] += rng.integers(1, 40)
    seen, sequences = np.zeros(65, dtype=np.int64), 0
    for config, n in packing.plan(counts, 64):
        assert sum(length * k for length, k in config) <= 64
        sequences += n
        for length, k in config:
            seen[length] += k * n
    assert (seen == counts).all()
    tokens = int((counts * np.arange(65)).sum())
    assert -(-tokens // 64) <= sequences <= sum(packing.best_fit_decreasing(counts, 64).values())


@pytest.mark.parametrize("seed", range(4))
def test_program_covers_everything_and_bounds_the_plan(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(257, dtype=np.int64)
    np.add.at(counts, np.clip(rng.lognormal(4, 1, 20_000).astype(int), 1, 256), 1)
    below = counts.copy()
    below[256] = 0
    fractional, bound = packing.fractional_plan(below, 256)
    cover = np.zeros(257)
    for config, x in fractional.items():
        assert packing._tokens(config) <= 256
        for length, n in config:
            cover[length] += x * n
    assert (cover >= below - 1e-6).all()
    assert bound <= sum(fractional.values()) + 1e-6
    # the price of a token alone gives the volume bound
    assert bound >= (below * np.arange(257)).sum() / 256 - 1e-6
    rounded, repair = packing.solve(counts, 256)
    total = sum(rounded.values()) + sum(repair.values())
    assert sum(n for _, n in packing.plan(counts, 256)) == total
    # a smaller share of the program's plan is used only where it saves a sequence
    whole, _ = packing.rounded_plan(below, fractional, 1.0, max(map(packing._tokens, fractional)))
    rest = below - sum(n * np.bincount([x for x, k in c for _ in range(k)], minlength=257)
                       for c, n in whole.items())
    assert (rest >= 0).all()
    full = sum(whole.values()) + sum(packing.best_fit_decreasing(rest, 256).values())
    assert total <= counts[256] + full and sum(rounded.values()) > counts[256]
    assert counts[256] + bound <= total + 1e-6 and total <= 1.002 * (counts[256] + bound) + 2


def test_program_without_a_full_configuration():
    counts = np.zeros(65, dtype=np.int64)
    counts[40] = 1000
    assert packing.solve(counts, 64) == ({((40, 1),): 1000}, {})
    assert packing.plan(counts, 64) == [(((40, 1),), 1000)]
    assert packing.plan(np.zeros(65, dtype=np.int64), 64) == []


def test_knapsack_is_exact():
    rng = random.Random(3)
    for _ in range(20):
        cap = 15
        value, most = np.zeros(cap + 1), np.zeros(cap + 1, dtype=np.int64)
        for length in rng.sample(range(1, cap + 1), 4):
            value[length], most[length] = rng.random(), rng.randint(1, 3)
        lengths = np.flatnonzero(most).tolist()
        best = max(sum(value[x] * n for x, n in zip(lengths, times, strict=True))
                   for times in product(*[range(most[x] + 1) for x in lengths])
                   if sum(x * n for x, n in zip(lengths, times, strict=True)) <= cap)
        config = packing.best_configuration(value, cap, most)
        assert sum(length * n for length, n in config.items()) <= cap
        assert all(n <= most[length] for length, n in config.items())
        assert sum(value[x] * n for x, n in config.items()) == pytest.approx(best)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(docs).collect()
    want = Counter()
    for doc_id, text, *_ in ROWS:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    rows = {}
    for r in got:
        rows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in rows.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty).count() == 0


# --- 4 -------------------------------------------------------------------------------------

def test_url_filter(spark):
    rows = [(1, "http://a.Example.org/es/x?y"), (2, "https://example.org/en/12"),
            (3, "https://example.org"), (4, None), (5, "no scheme"), (6, "http://notexample.com/fr/"),
            (7, "http://x.com/DE/"), (8, "http://myorg/"), (9, "http://shop.net/cart/1"),
            (10, "http://x.org/cart/1"), (10, "http://x.org/cart/1"), (11, "http://ads.x.net/a"),
            (12, "http://ads.x.net")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in url_filter.judge(df).collect()}
    assert got == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"),
        2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("example.org", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("", "", None, "allow"), 6: ("notexample.com", "/fr/", "com/fr/", "allow"),
        7: ("x.com", "/DE/", None, "allow"), 8: ("myorg", "/", None, "allow"),
        9: ("shop.net", "/cart/1", "carts", "block"), 10: ("x.org", "/cart/1", "org/", "allow"),
        11: ("ads.x.net", "/a", "advert hosts", "block"),
        12: ("ads.x.net", "", "advert hosts", "block")}
    assert url_filter.judge(df, ()).where("verdict = 'allow'").count() == len(rows)
    assert url_filter.judge(df.limit(0)).count() == 0


def test_index_uses_the_rarest_token():
    rule = url_filter.host_rule("block", "example.org", "/en/1")
    assert rule.tokens() == ["en", "example", "org"]
    assert url_filter.Rule("r", "block", "/a*b/c$").tokens() == ["c"]


# --- 5 -------------------------------------------------------------------------------------

def test_sentencepiece_against_the_library(docs, empty):
    """The library, told to run the same vocabulary as a best-path model."""
    import sentencepiece
    pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb2.ModelProto()
    with open(sentencepiece_lattice.model_path(), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    best_path = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    encoded = sentencepiece_lattice.encode(docs)
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    texts = {r[0]: r[1] for r in ROWS}
    for doc_id, text in texts.items():
        if text is None:
            assert got[doc_id] is None
        elif doc_id not in (14,):           # cut into parts, and long float sums in the library
            assert got[doc_id] == best_path.encode(text), doc_id
    back = {r["doc_id"]: r["text"] for r in sentencepiece_lattice.decode(encoded).collect()}
    assert back == texts
    assert sentencepiece_lattice.encode(empty).count() == 0


# --- 6, 7 ----------------------------------------------------------------------------------

def test_quality_rules(docs, empty):
    got = Counter(tuple(r) for r in quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    want = Counter()
    for doc_id, text, *_ in ROWS:
        words = WORD.findall(text or "")
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        many = Counter(grams)
        covered = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        want[doc_id, len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(covered),
             len(words) < 10 or 100 * len(covered) > 20 * len(words)] += 1
    assert got == want
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns and 15 not in {r["doc_id"] for r in kept.collect()}
    assert quality_rules.filter_documents(empty).count() == 0


def test_quality_classifier(spark, docs, empty):
    rows = [(i, _prose(i, 60) if i % 2 else "#$% " * 40 + _prose(i, 20), "en", "s", 1)
            for i in range(100, 220)]
    more = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 220)] + [(100, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality_classifier.score(more, labels).collect()
    assert len(got) == 120 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {
        i for i in range(100, 220) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r["predicted"] == r["doc_id"] % 2 for r in held)
    kept = quality_classifier.filter_documents(more, labels)
    assert kept.columns == more.columns and {r["doc_id"] % 2 for r in kept.collect()} == {1}
    none = quality_classifier.score(docs, labels.limit(0)).collect()
    assert len(none) == len(ROWS) and {round(r["score"], 6) for r in none} == {0.5}
    assert quality_classifier.score(empty, labels).count() == 0


# --- 8 -------------------------------------------------------------------------------------

def test_sharding(docs, empty):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    share = Counter(table)
    assert max(share.values()) - min(share.values()) <= 1 and -1 not in share
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != 6 and a != b for a, b in zip(table, fewer, strict=True))
    assert moved < 1009 * 0.2
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)
    placed = sharding.place(docs.withColumnRenamed("source", "slot"), shards=names, size=1009)
    assert placed.columns[-2:] == ["_slot", "shard"]
    for r in placed.collect():
        assert r["shard"] == names[table[r["_slot"]]]
    assert placed.count() == len(ROWS) and sharding.place(empty).count() == 0


# --- 9, 10 ---------------------------------------------------------------------------------

def _components(ids, links):
    up = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(up[a], up[b])
            if up[a] != low or up[b] != low:
                up[a] = up[b] = low
                changed = True
    return up


def test_embeddings_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "LEAF", 8)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    x = [(c + rng.normal(size=8) * s).tolist() for c in centres for s in (0.02, 0.1, 0.12, 0.3)
         for _ in range(12)]
    rows = [(i, v, i % 3) for i, v in enumerate(x)]
    rows += [(1000 + i, x[0], 0) for i in range(20)]
    rows += [(2000, None, 0), (2001, [0.0] * 8, 0), (2002, [float("nan")] * 8, 0),
             (2003, x[0], None), (2004, [None] + x[0][1:], 0), (2005, x[0][:4], 0), (2006, [], 0),
             (2007, [3 * v for v in x[0]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ok = [(i, np.array(v, dtype=float), k) for i, v, k in rows
          if v and k is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all()
          and any(v)]
    links = [(a, b) for a, u, k in ok for b, v, q in ok if a != b and k == q and len(u) == len(v)
             and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98]
    n, up = Counter(a for a, _ in links), _components([r[0] for r in rows], links)
    got = {r["vec_id"]: tuple(r)[1:] for r in cover_tree.near_duplicates(df).collect()}
    assert got == {i: (n[i], up[i], up[i] == i) for i, *_ in rows}
    assert cover_tree.near_duplicates(df.limit(0)).count() == 0


def test_nested_levels_cover_and_separate():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 6)).repeat(5, axis=0) + rng.normal(size=(200, 6)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    radii = cover_tree.radii_for(0.2)
    assert radii == [1.0, 0.5, 0.25, 0.125, 0.0625]
    path, dist = cover_tree.nest(x, radii)
    for level, radius in enumerate(radii):
        assert np.allclose(dist[:, level], np.linalg.norm(x - x[path[:, level]], axis=1))
        assert dist[:, level].max() <= radius
        above = path[:, level - 1] if level else np.zeros(len(x), dtype=int)
        for parent in set(above):
            centres = x[sorted(set(path[above == parent, level]))]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
            assert (apart[~np.eye(len(centres), dtype=bool)] > radius).all()


@pytest.mark.parametrize("same", [True, False])
def test_dual_traversal_prunes_and_takes_whole(same):
    rng = np.random.default_rng(9)
    radii = cover_tree.radii_for(0.2)

    def block(seed, spread):
        centres = np.random.default_rng(4).normal(size=(30, 16))
        x = np.concatenate([c + np.random.default_rng(seed).normal(size=(10, 16)) * spread
                            for c in centres])
        x = x[rng.permutation(len(x))]
        return x, cover_tree.Tree(x, np.arange(len(x)), *cover_tree.nest(
            x / np.linalg.norm(x, axis=1, keepdims=True), radii))

    for spread, most in ((0.001, 0), (0.1, 0.12)):      # tight copies need no comparison
        x, a = block(1, spread)
        y, b = (x, a) if same else block(2, spread)
        hit, compared = cover_tree.meet(a, b, 0.98)
        cos = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
        want = cos >= 0.98
        if same:
            np.fill_diagonal(want, False)
        assert (hit == want).all() and want.any()
        assert compared <= most * len(x) * len(y)


def test_upper_levels_prune_blocks(spark, monkeypatch):
    """Rows sent to the compare stage stay few where vectors have structure."""
    monkeypatch.setattr(cover_tree, "LEAF", 32)
    sent = []
    units = cover_tree._units
    monkeypatch.setattr(cover_tree, "_units",
                        lambda *a: sent.append(units(*a).count()) or units(*a))
    rng = np.random.default_rng(6)
    x = [(c + rng.normal(size=8) * 0.05).tolist() for c in rng.normal(size=(20, 8))
         for _ in range(20)]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, label int")
    assert cover_tree.near_duplicates(df).count() == len(x)
    assert len(sent) == 1 and sent[0] < 8 * len(x)      # 400 / 32 blocks without pruning


def _edited(text, share, rng):
    return " ".join("zz" + str(rng.randint(0, 9999)) if rng.random() < share else w
                    for w in text.split())


def test_minhash_shared_ids_are_one_node(spark):
    a, b, c = ("one two three four five six seven", "red green blue white black grey pink",
               "sun moon star cloud rain snow wind")
    rows = [(3, a), (5, a), (5, b), (7, b), (7, b), (9, c), (9, c), (11, c), (12, None), (12, b)]
    docs = spark.createDataFrame([*rows, *[(20, c)] * 40], "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"] > 0): r["component_id"]
           for r in minhash.near_duplicates(docs).collect()}
    assert got == {(3, True): 3, (5, True): 3, (7, True): 3, (12, True): 3, (12, False): 12,
                   (9, True): 9, (11, True): 9, (20, True): 9}
    assert minhash.near_duplicates(docs).count() == len(rows) + 40


def test_substring_digests_do_not_multiply_with_equal_rows(spark):
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(200))
    docs = spark.createDataFrame([(1, passage), *[(2, passage)] * 30], "doc_id long, text string")
    found = substring_dedup.repeats(docs).collect()
    assert Counter(r["doc_id"] for r in found) == {1: 1, 2: 30}
    assert all(r["text"] == passage and not r["changed"] for r in found if r["doc_id"] == 1)
    assert len({r["text"] for r in found if r["doc_id"] == 2}) == 1
    assert all(r["n_removed_words"] > 150 for r in found if r["doc_id"] == 2)


def test_minhash_against_all_pairs(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)        # groups beyond one block, too
    rng = random.Random(4)
    texts = {i: _edited(BASE, rng.choice([0, 0.005, 0.01, 0.02, 0.05]), rng) for i in range(20, 70)}
    more = docs.unionByName(spark.createDataFrame(
        [(i, t, "en", "c", 1) for i, t in texts.items()], DOCS).withColumnsRenamed(
        {"lang": "n_words"}))
    sets = {i: minhash.shingle_set(t) for i, t in
            [*[(r[0], r[1]) for r in ROWS if r[0] is not None], *texts.items()]}
    links = [(a, b) for a in sets for b in sets if a < b and minhash.linked(sets[a], sets[b])]
    up = _components(sets, links)
    got = {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(more).collect()}
    assert got.pop(None)[1:] == (None, True)
    assert got == {i: (len(s), up[i], up[i] == i) for i, s in sets.items()}
    assert up[2] == up[3] == 1 and up[9] == 8 and up[6] == 6
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and not {2, 3, 9} & {r["doc_id"] for r in kept.collect()}
    assert minhash.near_duplicates(empty).count() == 0


def test_posterior_bound():
    least = minhash.least_matches(0.85)
    assert len(least) == 8 and all(a < b for a, b in zip(least, least[1:], strict=False))
    assert least[-1] > 0.7 * 256 and least[0] < 0.6 * 32


def test_sentencepiece_blocks_without_words(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (2, "")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["ids"]) for r in sentencepiece_lattice.encode(rows).collect()),
                 key=str)
    assert got == [(1, None), (2, []), (2, [])]


def test_classifier_without_rules(spark):
    docs = spark.createDataFrame([(i, "some words, all equal") for i in range(200)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 4 > 0) for i in range(200)], "doc_id long, quality boolean") \
        .selectExpr("doc_id", "cast(quality as int) as quality")
    got = quality_classifier.score(docs, labels).collect()
    assert len(got) == 200 and len({r["score"] for r in got}) == 1
    assert abs(got[0]["score"] - 0.75) < 0.08 and {r["predicted"] for r in got} == {1}
    assert quality_classifier.filter_documents(docs, labels).count() == 200


def test_sentencepiece_packed_and_rare_words(spark, monkeypatch):
    """Words told beforehand or not, rows packed at once or one by one: the same ids; packing a
    block's rows takes fewer bytes than the rows."""
    import pyarrow as pa

    texts = ["one  two ", " three▁four five", "six,\nseven six", "", None, "a \nb é\u0301x 12.5 12.5",
             "▁", "  ", "\n", "word " * 300, "漢字 and 🙂"]
    rows = spark.createDataFrame([(i % 9, t) for i, t in enumerate(texts)],
                                 "doc_id long, text string")

    def encoded():
        return sorted(((r["doc_id"], r["ids"]) for r in sentencepiece_lattice.encode(rows).collect()),
                      key=str)

    told = encoded()
    monkeypatch.setattr(sentencepiece_lattice, "COMMON_WORDS", 2)
    monkeypatch.setattr(sentencepiece_lattice, "BLOCK_CHARS", 100)
    assert encoded() == told and len(told) == len(texts)
    back = sentencepiece_lattice.decode(sentencepiece_lattice.encode(rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=str) == \
        sorted(((i % 9, t and t.replace("▁", " ")) for i, t in enumerate(texts)), key=str)
    batch = pa.record_batch([pa.array([1, 0] * 500, pa.int32()),
                             pa.array([f"some words of text {k}" for k in range(1000)])],
                            names=["block", "text"])
    packed = list(sentencepiece_lattice._pack(iter([batch])))
    assert [b.column("block").to_pylist() for b in packed] == [[0], [1]]
    assert sum(b.nbytes for b in packed) < batch.nbytes / 2


def test_sentencepiece_cuts_each_text_once(spark, monkeypatch, tmp_path):
    """The texts' exchange is read twice, not made twice; passing words on early changes no ids."""
    rows = spark.createDataFrame([(i, f"word{'abcdefgh'[i % 8] * (i % 5)} é🙂 w{i}\n") for i in range(60)]
                                 + [(1, None), (2, "")], "doc_id long, text string")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))

    def encoded():
        df = sentencepiece_lattice.encode(rows)
        return sorted(map(tuple, df.collect()), key=str), df._jdf.queryExecution().executedPlan().toString()

    got = encoded()[0]
    assert len(got) == 62
    for name, value in {"COMMON_WORDS": 3, "HELD_WORDS": 4, "HELD_ROWS": 7, "BLOCK_CHARS": 200}.items():
        monkeypatch.setattr(sentencepiece_lattice, name, value)
    again, plan = encoded()
    assert again == got and "ReusedExchange" in plan
