"""Lattice scores, spelling variants and whitening against plain versions."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from matrixq.llm import lattice, variants, whitening

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def in_parts(df, n=5):
    return df.repartition(n)


# Lattice


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.Vocabulary.read(PIECES)


def all_cuts(word, weights):
    """Log probability by listing every way to cut the word."""
    def ways(at):
        if at == len(word):
            return 1.0
        total = sum(
            math.exp(w) * ways(at + len(p)) for p, w in weights.items()
            if isinstance(p, str) and word.startswith(p, at)
        )
        if word[at] not in weights:
            code = word[at].encode()
            total += math.exp(sum(weights[b] for b in code)) * ways(at + 1)
        return total
    return math.log(ways(0))


def test_marginal_of_all_cuts():
    pieces = ["▁", "a", "b", "ab", "ba", "▁a", "aba", "é"]
    logs = np.log(np.linspace(1, 3, len(pieces) + 256) / 1000)
    weights = {**dict(zip(pieces, logs)), **dict(enumerate(logs[len(pieces):]))}
    words = ["a", "abab", "bbb", "abaé", "xé", "漢a", "ababababa"]
    found = lattice.Lattice(pieces).marginals(words, [logs])[:, 0]
    assert np.allclose(found, [all_cuts("▁" + w, weights) for w in words], rtol=1e-12)
    slow = [lattice.Lattice(pieces).marginal(w, logs) for w in words]
    assert np.allclose(found, slow, rtol=1e-12)


def test_expected_pieces_by_derivative():
    """The expected count of a piece is the derivative of the log probability by its log weight."""
    pieces = ["▁", "a", "b", "ab", "▁a", "aba"]
    logs = np.log(np.linspace(1, 3, len(pieces) + 256) / 1000)
    words, net = ["abab", "aéa", "b", "aba"], lattice.Lattice(pieces)
    expected = net.expected(words, logs)
    for k in (0, 1, 2, 3, 4, 5, len(pieces) + "é".encode()[0], len(pieces) + 7):
        more, less = logs.copy(), logs.copy()
        more[k] += 1e-5
        less[k] -= 1e-5
        slope = (net.marginals(words, [more]) - net.marginals(words, [less])).sum() / 2e-5
        assert abs(slope - expected[k]) < 1e-5


def test_arcs_are_ordered_as_needed(vocabulary, monkeypatch):
    net, done = lattice.Lattice(vocabulary.pieces), []
    order = lattice.Lattice._order

    def noted(come, go, turn):
        done.append((order(come, go, turn)[0] == np.lexsort((go, turn))).all())
        return order(come, go, turn)

    monkeypatch.setattr(lattice.Lattice, "_order", staticmethod(noted))
    words = ["", "a", "words", "wörter", "unbelievable" * 30]
    net.marginals(words, [vocabulary.weights] * 3)
    assert done == [True]  # nothing is ordered for the sweep back, which is not asked for
    net.expected(words, vocabulary.weights)
    assert done == [True] * 3


def test_long_words_place_by_place(vocabulary):
    net = lattice.Lattice(vocabulary.pieces)
    word = "abc漢dxyzthe" * 600
    assert len(word) > lattice.STRETCH
    net.arcs([word])
    whole = net.forward(net.scores(vocabulary.weights))[net.last][0]
    assert math.isclose(net.marginals(["a", word], [vocabulary.weights])[1, 0], whole, rel_tol=1e-9)


def brute_base(rows):
    split = lambda t: Counter((t or "").encode().lower().split()) + Counter([b""])
    out = [zlib.crc32(str("" if d is None else d).encode()) % 7 == 2 for d, _ in rows]
    seen = Counter()
    for (_, t), o in zip(rows, out):
        if not o:
            seen += split(t)
    n, v = sum(seen.values()), len(seen)
    found = []
    for (d, t), o in zip(rows, out):
        c = split(t)
        base = sum(k * math.log10((seen[w] + 1) / (n + v + 1)) for w, k in c.items())
        found.append((d, o, sum(c.values()), sum(k for w, k in c.items() if seen[w]), n, round(base, 6)))
    return sorted(found, key=repr)


def scored(spark, df, vocabulary, of_class=None):
    rows = lattice.score(df, lattice.learn(df, vocabulary, of_class=of_class)).collect()
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in rows)
    return rows


def base_of(rows):
    return sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in rows), key=repr)


def test_lattice_base_and_odd_texts(spark, odd, nothing, vocabulary, monkeypatch):
    monkeypatch.setattr(lattice, "COUNTED", 3)
    monkeypatch.setattr(lattice, "HEAD", 4)  # nearly all words are joined by the shuffle
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert base_of(scored(spark, in_parts(odd), vocabulary, "lang")) == brute_base(rows)
    assert scored(spark, nothing, vocabulary, "lang") == []
    # No row to learn from: 5 is held out.
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2]
    alone = scored(spark, texts(spark, [(held[0], "some text")]), vocabulary)
    assert alone[0]["base_score"] == 0 and alone[0]["train_tokens"] == 0 and alone[0]["score"] < 0


def test_model_is_a_mixture_over_classes(spark, vocabulary, monkeypatch):
    """Scores by the definition, from the token table, and the same with any head."""
    rows = [(k, f"the {'cat' if k % 3 else 'dog'} sat {'x' * (k % 5)} zzqj{k}", str(k % 3)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    model = lattice.learn(df, vocabulary, of_class="kind")
    logs = {bytes(r["token"]): r["logs"] for r in model.tokens.collect()}
    assert len(model.shares) == 3 and math.isclose(sum(model.shares), 1)
    found = {r["doc_id"]: r["score"] for r in lattice.score(df, model).collect()}
    for k, text, _ in rows:
        ways = [
            math.log(share) + sum(logs[t][z] * n for t, n in lattice.tokens_of(text.encode()).items())
            for z, share in enumerate(model.shares)
        ]
        assert math.isclose(found[k], math.log10(sum(map(math.exp, ways))), rel_tol=1e-9)
    monkeypatch.setattr(lattice, "HEAD", 0)
    late = {r["doc_id"]: r["score"] for r in lattice.score(df, model).collect()}
    assert all(math.isclose(late[k], found[k], rel_tol=1e-9) for k in found)
    monkeypatch.setattr(lattice, "CLASSES", 2)
    assert len(lattice.learn(df, vocabulary, of_class="kind").shares) == 2


def test_training_fits_held_out_texts(spark, vocabulary, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

    def total(of_class=None):
        rows = [r for r in scored(spark, df, vocabulary, of_class) if r["held_out"]]
        return sum(r["score"] for r in rows)

    by_class, trained = total("lang"), total()
    monkeypatch.setattr(lattice, "ROUNDS", 0)
    assert by_class > trained > total()


# Spelling variants


def brute_variants(rows, least_letters=6, least_rows=5, ratio=5):
    low = {c: c + 32 for c in range(65, 91)}
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = run.translate(low)
            h = zlib.crc32(f"{'' if d is None else d}:{word}".encode())
            if h % 199 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            count[word] += 1
    v = {w: n for w, n in count.items() if len(w) >= least_letters and n >= least_rows}
    near = defaultdict(set)
    for a in v:
        for b in v:
            if a != b and (
                (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)
                or (len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a))))
                or (len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b))))
            ):
                near[a].add(b)
    form = {}
    for w in v:
        best = min(near[w], key=lambda x: (-v[x], x), default=None)
        if best and v[best] >= ratio * v[w]:
            form[w] = best
    out = []
    for w in v:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, v[w], len(near[w]), v[form[w]] if w in form else None))
    return sorted(out, key=repr)


def found_variants(df, **options):
    return sorted((tuple(r) for r in variants.group(df, **options).collect()), key=repr)


WORDS = [("letter", 400), ("leter", 2), ("lettter", 60), ("lettters", 9), ("letterss", 5), ("better", 80),
         ("bettér", 8), ("béttér", 80), ("aaaaaa", 30), ("aaaaaaa", 6), ("zzzzzz", 5), ("×÷×÷×÷", 25),
         ("×÷×÷×", 5), ("×÷×÷×÷×", 5), ("mettle", 10), ("nettle", 10), ("kettle", 10)]


def test_variants_small(spark, odd, nothing, monkeypatch):
    rows = [(k % 7 if k % 7 else None, f"{w.upper() if k % 2 else w}. 漢{w}") for w, n in WORDS for k in range(n)]
    df = in_parts(texts(spark, rows))
    assert found_variants(df) == brute_variants(rows)
    chain = {r[0]: r for r in found_variants(df)}
    assert chain["lettters"][1] == "lettter" and chain["lettters"][2] == "letter"
    for name, value in (("FILTER_WORDS", 2), ("COUNTED", 2), ("AT_HAND", 300)):
        monkeypatch.setattr(variants, name, value)
    assert found_variants(df) == brute_variants(rows)  # crowded filters, small steps
    plain = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert found_variants(odd, least_rows=1, least_letters=3) == brute_variants(plain, 3, 1)
    assert found_variants(nothing) == []


def test_letters_lost_by_checksum(spark):
    """Some occurrences lose a letter, told by document and run together."""
    word = "reproduction"
    lost = [k for k in range(3000) if zlib.crc32(f"{k}:{word}".encode()) % 199 == 0]
    rows = [(k, f"{word} Reproduction") for k in [*lost, *range(5000, 5100)]]
    assert lost and found_variants(texts(spark, rows), least_rows=1) == brute_variants(rows, least_rows=1)


def test_very_long_words(spark):
    rows = [(k, "y" * 30_000) for k in range(5)] + [(k, "y" * 29_999 + "z") for k in range(30)]
    found = {r[0][-1]: r for r in found_variants(texts(spark, rows))}
    assert found["y"][4] == found["z"][4] == 1 and found["y"][2][-1] == "z"


# Whitening


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def check_whitening(spark, rows, components=8):
    found = whitening.whiten(vectors(spark, rows).repartition(3), components=components).collect()
    good = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    x = np.array([[math.floor(1024 * c) for c in v] + [0] * (width - len(v)) for _, v in good]) + 100_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    k = max(r["component"] for r in found)
    w = c @ v[:, :k] / np.sqrt(e[:k])
    assert len(found) == n * k
    by = lambda r: (repr(r[0]), r[1])
    expected = sorted(
        ((good[r][0], j + 1, n, sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[r], s)), w[r, j], e[j] / e.sum())
         for r in range(n) for j in range(k)), key=by)
    got = sorted((tuple(r) for r in found), key=by)
    # Rows without id are told apart by their deviation only.
    expected.sort(key=lambda r: (*by(r), r[3]))
    got.sort(key=lambda r: (*by(r), r[3]))
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    for j in range(k):
        a = np.array([r[4] for r in got if r[1] == j + 1])
        b = np.array([r[4] for r in expected if r[1] == j + 1])
        sign = np.sign(a @ b)
        assert np.abs(a - sign * b).max() < 1e-6
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-6)
    assert max(r[6] for r in got) < 1e-9 and len({r[6] for r in got}) == 1
    return k


def test_whitening_equals_eigenvectors(spark):
    random = np.random.default_rng(1)
    rows = [(k, (random.normal(size=12) * np.geomspace(1, 30, 12)).tolist()) for k in range(300)]
    assert check_whitening(spark, rows) == 8
    assert check_whitening(spark, [*rows, rows[0], rows[0]], components=3) == 3


def test_whitening_of_odd_rows(spark):
    rows = [(k, [float(k), 2.0 * k, 1.0, (k * k % 7) * 0.1]) for k in range(40)]
    odd = [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [math.nan] * 4), (53, [math.inf] * 4)]
    # Two of the four places depend on others, so two components have no variance.
    assert check_whitening(spark, [*rows, *odd]) == 2
    short = [(None, [5.0]), (3, []), (None, [0.5, 2.5, 3.0, 4.0])]
    assert check_whitening(spark, [*rows, *short]) >= 3


def test_whitening_without_variance(spark):
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(vectors(spark, [(k, [1.0]) for k in range(5)])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, []), (2, None)])).collect() == []
    assert whitening.whiten(vectors(spark, []).where("false")).collect() == []


def test_badly_conditioned_rows(spark):
    """Scales far apart: the Gram matrix alone would lose the small ones."""
    random = np.random.default_rng(2)
    mix = np.linalg.qr(random.normal(size=(5, 5)))[0]
    rows = [(k, (random.normal(size=5) * [1e7, 1e5, 1e3, 10, 1] @ mix).tolist()) for k in range(400)]
    found = whitening.whiten(vectors(spark, rows)).collect()
    x = np.floor(1024 * np.array([v for _, v in rows]))
    c = x - x.mean(0)
    singular = np.linalg.svd(c, compute_uv=False)
    for r in found:
        share = singular[r["component"] - 1] ** 2 / (singular**2).sum()
        assert math.isclose(r["explained"], share, rel_tol=1e-4)
    assert {r["component"] for r in found} == {1, 2, 3, 4, 5} and found[0]["identity_error"] < 1e-6


def test_deviation_beyond_64_bits(spark):
    rows = [(k, [float(k) * 2.0**28, 1.0]) for k in range(3)]
    found = whitening.whiten(vectors(spark, rows)).collect()
    exact = {k: (3 * (k << 38) - 3 * (1 << 38)) ** 2 for k in range(3)}
    assert all(r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 1 << 63 else None) for r in found)
    assert {r["deviation"] is None for r in found} == {True, False}


def test_columns_with_clashing_names(spark):
    df = vectors(spark, [(k, [float(k), float(k * k)]) for k in range(5)])
    extra = df.withColumns({c: F.lit("x") for c in ("vector", "n", "at", "x", "component")})
    assert whitening.whiten(extra).count() == whitening.whiten(df).count() == 10
