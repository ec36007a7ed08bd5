import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matrixq import session
from matrixq.llm import bpe, licenses, lines, minhash, mixing, suffixes, toxicity, urls
from matrixq.llm.components import components
from matrixq.llm.queries import WORD_TOKENIZER
from tests.llm.conftest import ODD_TEXTS


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# Line dedup


def test_automaton_equals_edit_distance(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = rng.choices("abc ", k=rng.randint(0, 25))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choices("abc", k=rng.randint(0, 1))
        pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").select("*", F.levenshtein("a", "b").alias("d"))
    df = lines.trimmed(df, "a", "b").cache()
    for k in (1, 2, 3):
        wrong = lines.within(F.col("a"), F.col("b"), k) != (F.col("d") <= k)
        assert df.where(wrong).count() == 0
        assert df.where((F.col("d") <= k) & ~lines.plausible(F.col("a"), F.col("b"), F.lit(k))).count() == 0


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def brute_lines(rows, edits, per_edit):
    firsts, out = {}, {}
    order = [(d, k, line) for d, t in sorted(rows) for k, line in enumerate(t.split("\n"))]
    for d, k, line in order:
        firsts.setdefault(line, (d, k))
    near = {
        at for line, at in firsts.items() for other, before in firsts.items()
        if before < at and brute_distance(line, other) <= min(edits, len(line) // per_edit, len(other) // per_edit)
    }
    for d, k, line in order:
        if not line or (firsts[line] == (d, k) and (d, k) not in near):
            out.setdefault(d, []).append(line)
    return {d: "\n".join(x for x in out.get(d, []) if x) for d, _ in rows}


@pytest.mark.parametrize("edits, crowd", [(1, 200), (2, 200), (1, 2), (2, 3)])
def test_lines_equal_brute_force(spark, monkeypatch, edits, crowd):
    monkeypatch.setattr(lines, "CROWD", crowd)
    rng = random.Random(edits)
    base = ["".join(rng.choices("abcdefg ", k=rng.randint(8, 24))) for _ in range(8)]

    def line():
        x = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(x))
            x[at : at + rng.randint(0, 1)] = rng.choice("abc")
        return "".join(x)

    rows = [(d, "\n".join(line() for _ in range(rng.randint(1, 5)))) for d in range(30)]
    found = lines.dedup(texts(spark, rows), edits=edits, chars_per_edit=5).collect()
    assert {r["doc_id"]: r["text"] for r in found} == brute_lines(rows, edits, 5)


@pytest.mark.parametrize("seed, crowd, spots, longest", [(1, 2, 3, 40), (2, 3, 5, 60), (5, 2, 8, 90)])
def test_crowds_equal_brute_force(spark, monkeypatch, seed, crowd, spots, longest):
    """Families of lines that differ in a few letters here and there, so that most segments are
    crowded at every depth, down to the patterns."""
    monkeypatch.setattr(lines, "CROWD", crowd)
    monkeypatch.setattr(lines, "ALIKE", crowd)
    monkeypatch.setattr(lines, "LEVELS", lines.LEVELS[: seed - 1])
    rng = random.Random(seed)

    def family():
        base = rng.choices("abcdefghij ", k=rng.randint(20, longest))
        places = sorted(rng.sample(range(len(base)), spots))
        for _ in range(25):
            x = list(base)
            for at in reversed(places):
                x[at : at + rng.choice([1, 1, 1, 0, 2])] = rng.choice(["x", "y", "z", "xy", "", "a"])
            yield "".join(x)

    each = [x for _ in range(4) for x in family()]
    rng.shuffle(each)
    rows = [(d, "\n".join(each[5 * d : 5 * d + 5])) for d in range(20)]
    found = lines.dedup(texts(spark, rows), chars_per_edit=10).collect()
    assert {r["doc_id"]: r["text"] for r in found} == brute_lines(rows, 2, 10)


def test_patterns_tell_edits(spark):
    """Two texts have a pattern of e jokers in common if and only if they are within e edits."""
    rng = random.Random(5)
    some = ["".join(rng.choices("abc", k=rng.randint(0, 6))) for _ in range(40)]
    df = spark.createDataFrame([(x,) for x in some], "x string")
    for edits in (1, 2):
        found = [set(r[0]) for r in df.select(lines.patterns(F.col("x"), edits)).collect()]
        for a, p in zip(some, found):
            for b, q in zip(some, found):
                near = brute_distance(a, b) <= edits
                assert bool(p & q) == near, (a, b, edits)


def test_crowds_grow_in_proportion(spark, monkeypatch):
    """Lines that differ in two neighbouring letters: one stays, and the work follows the lines."""
    signs = [chr(c) for c in range(ord("A"), ord("A") + 45)]
    rows_of, seen = lines.written, {}

    def counted(df, name):
        out = rows_of(df, name)
        seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(lines, "written", counted)
    sizes = {}
    for n in (16, 45):
        seen.clear()
        each = [f"the beginning of a long line {a}{b} and its very end" for a in signs[:n] for b in signs[:n]]
        found = lines.dedup(texts(spark, [(k, x) for k, x in enumerate(each)])).collect()
        assert [r["doc_id"] for r in found if r["text"]] == [0]
        sizes[n * n] = sum(v for k, v in seen.items() if k.startswith("crowd") or k == "line-pairs")
    assert sizes[2025] <= 60 * 2025 and sizes[2025] <= 1.2 * 2025 / 256 * sizes[256]


def test_sparse_crowds_do_not_double(spark, monkeypatch):
    """Lines of one mould with a different word each: none goes, and the rows of a round do not
    grow with the rounds."""
    rng = random.Random(6)
    rows_of, rounds = lines.written, []

    def counted(df, name):
        out = rows_of(df, name)
        if name in ("crowd", "crowd-classes"):
            rounds.append(out.count())
        return out

    monkeypatch.setattr(lines, "written", counted)
    monkeypatch.setattr(lines, "ALIKE", 20)
    words = {"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(300)}
    each = [f"dear {w}, thank you very much for your letter of last week, we are glad to hear" for w in sorted(words)]
    found = lines.dedup(texts(spark, [(k, x) for k, x in enumerate(each)])).collect()
    assert all(r["text"] for r in found)
    assert rounds and max(rounds) <= 12 * len(each)


def test_lines_with_free_code_points(spark, monkeypatch):
    """Marks and jokers within texts: not compared within crowds."""
    odd = "a line of more than forty characters with \ufdd0 and \U000f0000"
    rows = [(1, odd), (2, odd.replace("forty", "forte")), (3, odd), (4, odd[:-1] + "x")]
    found = lines.dedup(texts(spark, rows)).collect()
    assert {r["doc_id"] for r in found if r["text"]} == {1}
    monkeypatch.setattr(lines, "CROWD", 1)
    found = lines.dedup(texts(spark, rows)).collect()
    assert {r["doc_id"] for r in found if r["text"]} >= {1} and len(found) == 4


def test_lines_without_broadcast(spark):
    rows = [(1, "x\ny"), (2, "x\nz"), (3, "y\nx\nw")]
    found = lines.dedup(texts(spark, rows), broadcast_rows=0).collect()
    assert {r["doc_id"]: r["text"] for r in found} == {1: "x\ny", 2: "z", 3: "w"}


def test_lines_odd_rows(odd, nothing):
    rows = lines.dedup(odd).collect()
    assert len(rows) == len(ODD_TEXTS) and {r["n"] for r in rows} == {"n"}
    left = {(r["doc_id"], r["text"]) for r in rows}
    assert {(1, ""), (2, ""), (4, "one"), (8, "a\nb\nc"), (None, "")} <= left
    assert lines.dedup(nothing).count() == 0


# MinHash


def brute_groups(rows, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").lower().split()
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_copies(seed, n, words=60):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(words)] for _ in range(3)]
    rows = []
    for d in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 8])):
            w[rng.randrange(len(w))] = rng.choice("xyz") * rng.randint(1, 9)
        rows.append((d, " ".join(w)))
    return rows


@pytest.mark.parametrize("percent", [85, 60])
def test_groups_equal_brute_force(spark, percent):
    rows = near_copies(4, 120)
    found = minhash.near_duplicates(texts(spark, rows), percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_groups(rows, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_large_clusters_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "MEMBERS", 10)
    monkeypatch.setattr(minhash, "BUCKET", 12)
    rows = near_copies(5, 150)
    found = minhash.near_duplicates(texts(spark, rows), 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_groups(rows, 85)


def test_groups_odd_rows(odd, nothing):
    rows = minhash.near_duplicates(odd, 85).collect()
    assert len(rows) == len(ODD_TEXTS) and {r["node"] for r in rows} == {"node"}
    assert sum(r["first"] for r in rows if r["component_id"] == 4) == 1  # twice id 4, once no id
    assert {(r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] in (1, 2, 3)} == {
        (0, 1), (0, 2), (0, 3)}
    assert minhash.near_duplicates(nothing, 85).count() == 0


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)] + [(200, x) for x in range(201, 260)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    of = {r["node"]: r["component"] for r in found}
    assert len(of) == len(found)
    assert {of[k] for k in range(41)} == {0} and {of[x] for x in (90, 95, 100)} == {90}
    assert {of[x] for x in range(200, 260)} == {200}


def test_signature_estimates():
    minima = minhash.Minima()
    rng = random.Random(1)
    import numpy as np

    for share in (0.5, 0.85):
        both = np.array([rng.getrandbits(64) for _ in range(2000)], np.uint64)
        a = both[: int(2000 * (1 + share) / 2)]
        b = both[len(both) - len(a):]
        one, two = (np.frombuffer(minima.packed(minima.of(x)), np.uint64) for x in (a, b))
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(minhash.estimates(one, two) - exact) < 0.15


# Suffix dedup


def brute_suffixes(rows, length):
    seen, out = {}, {}
    for d, t in sorted(rows):
        raw = t.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if seen.setdefault(raw[p : p + length], (d, p)) != (d, p):
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out[d] = (len(raw), sum(gone), spans, bytes(c for c, x in zip(raw, gone) if not x))
    return out


@pytest.mark.parametrize("alphabet, crowd", [("ab", 5000), ("abcdefgh é", 5000), ("ab", 3)])
def test_suffixes_equal_brute_force(spark, monkeypatch, alphabet, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng = random.Random(len(alphabet))
    passages = ["".join(rng.choices(alphabet, k=rng.randint(10, 60))) for _ in range(5)]
    rows = [
        (d, "".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(alphabet, k=15))
                    for _ in range(rng.randint(0, 6)))) for d in range(40)
    ] + [(99, "a" * 300), (98, "a" * 150)]
    found = suffixes.dedup(texts(spark, rows), length=20, gram=8).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found}
    assert got == brute_suffixes(rows, 20)


def test_suffixes_odd_rows(odd, nothing):
    rows = suffixes.dedup(odd).collect()
    assert len(rows) == len(ODD_TEXTS)
    of = {r["doc_id"]: r for r in rows}
    assert of[1]["n_bytes"] == 0 and of[5]["n_removed"] == 150_000 - 5  # only the first period starts first
    assert bytes(of[6]["kept"]) == b"x" and of[6]["n_spans"] == 1
    assert suffixes.dedup(nothing).count() == 0


def test_texts_go_to_python_in_small_batches(spark):
    before = spark.conf.get(session.ARROW_BYTES)
    df = texts(spark, [(d, str(d) * 5000) for d in range(4000)]).coalesce(1)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["n"])

    try:
        for use in (
            lambda: bpe.encode(df, WORD_TOKENIZER), lambda: suffixes.dedup(df.limit(3)),
            lambda: minhash.near_duplicates(df.limit(3), 80),
            lambda: toxicity.learn(df.limit(3), labels),
        ):
            spark.conf.set(session.ARROW_BYTES, "64m")
            use()
            sizes = [r["n"] for r in df.select("text").mapInArrow(count, "n long").collect()]
            assert max(sizes) < 1.2 * session.BATCH_BYTES < sum(sizes)
        spark.conf.set(session.ARROW_BYTES, "100kb")
        bpe.encode(df, WORD_TOKENIZER)
        assert spark.conf.get(session.ARROW_BYTES) == "100kb"  # a smaller one is kept
    finally:
        spark.conf.set(session.ARROW_BYTES, before)


def test_suffixes_shuffle_texts_once(spark):
    rows = [(d, f"{d} " + "some words that come again " * 6) for d in range(20)]
    out = suffixes.dedup(texts(spark, rows))
    assert len(out.collect()) == 20
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Two cogroups read the texts, which are shuffled for one of them.
    assert plan.count("FlatMapCoGroupsInArrow") == 2 and plan.count("ReusedExchange") == 1


def test_suffixes_pack_runs_small():
    rng = np.random.default_rng(1)
    rows = np.zeros(10_000, suffixes.RUN)
    for name, most in [("gram", 1 << 63), ("whole", 1 << 63), ("doc", 300_000), ("body", 1 << 63),
                       ("first", 5000), ("many", 58)]:
        rows[name] = rng.integers(0, most, len(rows))
    data = suffixes._bytes(rows)
    assert (suffixes._rows(data, suffixes.RUN) == rows).all()
    # Bytes that are no noise cost little; rows one after the other would keep a tenth more.
    assert len(pa.compress(data, "lz4_raw", asbytes=True)) < 0.8 * len(data)
    assert not len(suffixes._rows(suffixes._bytes(rows[:0]), suffixes.RUN))


# Toxicity


def toxic_rows(n=400):
    rng = random.Random(2)
    words = ["the", "house", "green", "water", "runs", "over", "stone", "and", "light", "tree"]
    rows = []
    for d in range(n):
        w = rng.choices(words, k=20)
        bad = d % 5 == 0
        if bad:
            w[rng.randrange(20)] = rng.choice(["idiot", "stupid"])
        rows.append((d, " ".join(w), int(bad)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = toxic_rows()
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    return toxicity.learn(texts(spark, [(d, t) for d, t, _ in rows]), labels).prepare()


def test_lexicon_and_disguises(model):
    assert set(model.weights) == {"idiot", "stupid"}
    for text in ("you idiot", "an 1d10t", "i d i o t s? no: i d i o t", "idiooot!!", "s.t.u.p.i.d", "$tup1d", "STUPID***"):
        assert model.score(text) >= toxicity.THRESHOLD, text
    for text in ("the green house", "10 stones", "a b c d", "!!!", "", None, "stone 1001 3:15"):
        assert model.score(text) < toxicity.THRESHOLD, text


def test_disguises_in_signs_of_any_script(model):
    for text in ("$tupid!", "!diot!!", "\u201cstupid\u201d", "stupid\u2026", "stu\u200bpid", "\u00abidiot\u00bb,", "i\u200bd\u00b7i\u2011ot\u3002",
                 "\u201c$tup1d!\u201d", "s\u0336t\u0336u\u0336pid", "\u201cidiot\u201d\u2026"):
        assert model.score(text) >= toxicity.THRESHOLD, text
    for text in ("\u201cthe green house\u201d\u2026", "\u201c10 stones\u201d", "\u200b", "\u2026!$", "na\u00efve\u2019s"):
        assert model.score(text) < toxicity.THRESHOLD, text
    assert toxicity.words_in("\u201cSt\u200bone\u201d\u2026 \u0915\u0940, \u2026 don't") == ["stone", "\u0915\u0940", "don't"]
    signs = toxicity.Model(model.trigrams, {"ass": 3.0}, -3.0).prepare()
    assert signs.restored("@$$") == ["ass"]


def test_what_decoding_restores_passes_the_prefilter(model):
    rng = random.Random(7)
    like = {}
    for sign, letters in toxicity.LOOKS.items():
        for x in letters:
            like.setdefault(x, []).append(sign)
    around = ["", "!", "$", "(", "1", "\u201c", "\u2026", "\u200b", ".", "+", "x"]
    restored = 0
    for _ in range(4000):
        out = [rng.choice(around), rng.choice(around)]
        for c in rng.choice(sorted(model.weights)):
            out += rng.choice(like.get(c, [c]) + [c] * 3) * rng.choice([1, 1, 1, 2])
            out += rng.choice([""] * 12 + around)
        token = "".join(out + [rng.choice(around), rng.choice(around)])
        own = model.weights.keys() & model.decode(token)
        restored += bool(own)
        assert own <= set(model.restored(token)), token
        apart = " ".join(token)
        assert not model.weights.keys() & model.decode(apart) or model.may_hold(apart), apart
    assert restored > 1000


def test_scores_of_all_rows(spark, model, odd, nothing):
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(nothing, model).count() == 0
    restored = toxicity.restore(texts(spark, [(1, "An 1D10T"), (2, None)]), model).collect()
    assert [r["restored"] for r in restored] == ["an idiot", ""]


def test_no_labels(spark, odd, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(nothing, labels).prepare()
    assert model.score("idiot") < 1e-9 and not model.weights


def test_held_out_quality(spark):
    from matrixq.llm.queries import op6_toxicity

    d = "/root/testdata/sf0.01"
    rows = op6_toxicity(spark, d).where("held_out").join(
        spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in clean)
    assert wins / (len(toxic) * len(clean)) > 0.75


# URLs and licences


def test_urls(spark):
    entries = spark.createDataFrame(
        [("net", "/", "block", False), ("example.net", "/en/", "allow", False), ("junk.org", "/", "block", True),
         ("a.example.net", "/en", "block", False)],
        "host string, path string, verdict string, listed boolean")
    rows = [(1, "http://X.example.NET/en/1"), (2, "http://b.net"), (3, "http://b.net/"), (4, None), (5, "no url"),
            (6, "https://www.junk.org/x?y"), (7, "http://notnet/"), (8, "http://a.example.net/en/2"),
            (3, "http://b.net/"), (9, "http://a.example.net/de"), (10, ""), (11, "x?u=://junk.org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("h", F.lit(1)).withColumn("best", F.lit(2))
    for limit in (200_000, 0):
        found = urls.judge(pages, entries, broadcast_entries=limit).collect()
        got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found)
        assert got == Counter([
            (1, "x.example.net", "/en/1", "example.net/en/", "allow"), (2, "b.net", "", None, "allow"),
            (3, "b.net", "/", "net/", "block"), (3, "b.net", "/", "net/", "block"), (4, "", "", None, "allow"),
            (5, "", "", None, "allow"), (6, "www.junk.org", "/x", None, "block"), (7, "notnet", "/", None, "allow"),
            (8, "a.example.net", "/en/2", "a.example.net/en", "block"), (9, "a.example.net", "/de", "net/", "block"),
            (10, "", "", None, "allow"), (11, "junk.org", "/", None, "block")])
    assert urls.judge(pages.where("false"), entries).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, entries.where("false")).collect()} == {"allow"}


def test_no_false_negatives_in_filter(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    bloom = urls.bloom_filter(keys, 40)  # far too small: false positives, never a false negative
    masks = [m.alias(f"m{w}") for w, m in enumerate(urls._masks(F.col("h")))]
    probe = keys.select("h", F.pmod("h", F.lit(40)).alias("block"), *masks).join(bloom, "block")
    hit = " and ".join(f"(w{w} & m{w}) = m{w}" for w in range(4))
    assert probe.where(hit).count() == 5000


def test_licenses(spark, odd, nothing):
    rows = [
        (1, "x\nAll rights\nreserved, all rights reserved"), (2, "Licensed under CC BY-NC 4.0."),
        (3, "licensed under cc"), (4, None), (5, "cc by cc by"), (6, "Released under MIT License today"),
    ]
    found = {r["doc_id"]: r for r in licenses.scan(texts(spark, rows)).collect()}
    pick = lambda d: tuple(found[d][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels"))
    assert pick(1) == (7, 2, 1, 4, "reserved", "all-rights-reserved,reserved")
    assert pick(2) == (7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0")
    assert pick(4) == (0, 0, None, None, "", "") and found[3]["labels"] == ""
    assert pick(5)[:4] == (4, 2, 0, 2)
    assert found[6]["labels"] == "mit" and found[6]["score"] == 0.8
    rows = licenses.scan(odd).collect()
    assert len(rows) == len(ODD_TEXTS) and {r["spaced"] for r in rows} == {"spaced"}
    assert licenses.scan(nothing).count() == 0


def labels_of(spark, lines):
    found = licenses.scan(texts(spark, list(enumerate(lines)))).collect()
    own = {r["doc_id"]: sorted({s["label"] for s in r["spans"] or []}) for r in found}
    return [own[k] for k in range(len(lines))]


def test_licenses_need_deciding_words(spark):
    far = "Licensed under " + "word " * 400 + "the Apache License, " + "word " * 400 + "Version 2.0"
    lines = [
        "Licensed under CC BY 4.0", "Released under the Apache License",
        "This work is licensed under the GNU General Public License, version 2.0", far,
        "Licensed under Apache License, Version 2.0", "Released under MIT License",
        "word " * 500 + "Licensed under the word Apache License, Version 2.0 " + "word " * 500,
        "This work is licensed under the GNU General Public License, version 3",
    ]
    assert labels_of(spark, lines) == [[], [], [], [], ["apache-2.0"], ["mit"], ["apache-2.0"], ["gpl-3.0"]]


def test_licenses_wrapped_over_lines(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files")
    bsd = (" * Redistribution and use in source and binary forms, with or without\n"
           " * modification, are permitted provided that")
    lines = [mit, bsd, "x\n\nAll rights\nreserved", "All rights " + "word\n" * 30 + "reserved", "Licensed under CC BY\n4.0",
             "der mit.\nEiner im dem.\nLicensed under the Apache License, Version 2.0."]
    assert labels_of(spark, lines) == [["mit"], ["bsd"], ["all-rights-reserved"], [], [], ["apache-2.0"]]


def brute_licenses(text):
    words = [(k, w) for k, line in enumerate(text.split("\n")) for w in licenses.words_of(line)]
    best = {}
    for label, template in licenses.TEMPLATES:
        each = licenses.words_of(template)
        own, musts = set(each), set(each) & set(licenses.DECIDING[label])
        for s, (line, first) in enumerate(words):
            block = [w for at, (k, w) in enumerate(words[s : s + licenses.SPAN * len(each)])
                     if w in own and (k == line or at < len(each))]
            shared = len(set(block))
            if first not in own or shared < licenses.CONTAINMENT * len(own) - 1e-9 or musts - set(block):
                continue
            if first not in block[1:] or len(set(block[: block.index(first, 1)])) == shared:
                best[label, line] = max(best.get((label, line), 0), shared / len(own))
    return sorted((label, line, share) for (label, line), share in best.items() if share)


def test_licenses_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for d in range(300):
        out = []
        for _ in range(rng.randint(1, 4)):
            out += rng.choices(["word", "the", "and", "license"], k=rng.randint(0, 12))
            for w in licenses.words_of(rng.choice(licenses.TEMPLATES)[1]):
                out += [w] * (rng.random() < 0.93) + ["word"] * rng.choice([0, 0, 0, 0, 1, 3])
        rows.append((d, "".join(w + rng.choice([" ", " ", " ", " ", "\n"]) for w in out)))
    found = {r["doc_id"]: [tuple(s) for s in r["spans"] or []] for r in licenses.scan(texts(spark, rows)).collect()}
    expected = {d: brute_licenses(text) for d, text in rows}
    assert sum(map(len, expected.values())) > 150
    assert found == expected


# Mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, fixed = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(target[s] for s in fixed)
        open_ = [s for s in order if s not in fixed]
        share = rest / max(1, sum(weight[s] for s in open_))
        over = [s for s in open_ if weight[s] * share >= most * sizes[s]]
        for s in open_:
            target[s] = min(most * sizes[s], weight[s] * share)
        if not over:
            return target
        fixed |= set(over)


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 20)
    rng = random.Random(6)
    rows = [(d, rng.choice(["a", "a", "a", "b", "c", "d", None, "é"]), rng.choice([0, 1, 7, 7, rng.randint(1, 90)]))
            for d in range(1500)] + [(9000, "tiny", 3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = mixing.mix(df).collect()
    assert sorted(found) == sorted(mixing.mix(df.repartition(7)).collect())
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    target = brute_targets(sizes)
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, n in target.items():
        assert abs(taken[s] - n) <= 90


def test_mix_odd_rows(odd, nothing):
    rows = mixing.mix(mixing.sized(odd), size="size").collect()
    assert len(rows) == len(ODD_TEXTS) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(mixing.sized(nothing), size="size").count() == 0


