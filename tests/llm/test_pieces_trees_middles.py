"""SentencePiece encoding, Merkle manifests and fill-in-middle, against the library and brute force."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidewell.llm import fill_in_middle, merkle, piece_bpe, queries

ODD = "aaab  \t\n0123é▁中文😀\0.,-'the<0x41><unk><s>"
CLASHES = "doc_id bigint, text string, lang string, ids string, form string, g string, rank int, proof string, leaf string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    pick = lambda n: "".join(rng.choice(ODD) for _ in range(n))
    texts = [None, "", " ", "\n\n", "a", "é", "<P> x", "end<", " x", "x ", "中文 😀 und", "a<S", "<M"]
    texts += [pick(rng.randrange(60)) for _ in range(300)] + ["same text é"] * 40
    texts += ["".join(rng.choice("abcdefé ") for _ in range(200_000)), "x" * 50_000, " " * 3_000, "wort😀 " * 20_000]
    out = [(i, t, ("en", None, "de", "zz", "é")[i % 5 if i < 200 else 0], "x", "x", "x", 1, "x", "x") for i, t in enumerate(texts)]
    return out + [(None, "no id é", None, "x", "x", "x", 1, "x", "x")] * 3 + [out[20]] * 2


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, CLASHES).repartition(5)


# -- sentencepiece ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


@pytest.fixture(scope="module")
def encoder():
    with open(queries.piece_model(), "rb") as model:
        return piece_bpe.Encoder(piece_bpe.Model(model.read()))


def test_pieces_are_the_librarys(docs, rows, library):
    path = queries.piece_model()
    for found in (piece_bpe.round_trip(docs, path), piece_bpe.decode(piece_bpe.encode(docs, path), path)):
        seen = found.collect()
        assert Counter(r.document.doc_id for r in seen) == Counter(r[0] for r in rows)
        for r in seen:
            assert r.ids == library.encode(r.document.text or "")
            assert r.decoded == library.decode(r.ids) == (r.document.text or "").replace("▁", " ")


def test_random_texts_of_pieces(encoder, library):
    rng = random.Random(11)
    pieces = list(encoder.model.ids)
    for i in range(20_000):
        if i % 3 == 0:
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
        elif i % 3 == 1:
            text = "".join(rng.choice(ODD) for _ in range(rng.randrange(40)))
        else:
            text = rng.choice("ab .=-e") * rng.randrange(1, 70) + rng.choice(pieces)
        assert encoder.encode([text]) == [library.encode(text)], text


def test_backtracking_is_the_definition(encoder):
    """Whole texts, uncut, against merging from single characters; and failed places do come up."""
    rng, retreats = random.Random(12), 0
    pieces = [p for p in encoder.model.ids if len(p) > 1]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(4))
        tokens = encoder.tokens(text)
        assert tokens == encoder.merged(text)
        greedy, at = [], 0
        while at < len(text):
            n = next(n for n in range(16, 0, -1) if n == 1 or text[at : at + n] in encoder.model.ids and at + n <= len(text))
            greedy.append(text[at : at + n])
            at += n
        retreats += greedy != tokens
    assert retreats > 100


def test_caches_are_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE", 50)
    rng = random.Random(13)
    for _ in range(300):
        text = " ".join("".join(rng.choice("abcdef") for _ in range(6)) for _ in range(20))
        assert encoder.encode([text]) == [library.encode(text)]
    assert encoder.encode(["x" * 5000]) == [library.encode("x" * 5000)] and not any(len(p) > 64 for p in encoder.seen)
    assert len(encoder.seen) <= 50 and sum(map(len, encoder.compatible.values())) <= 50


def test_models_that_need_more_are_refused(encoder):
    with open(queries.piece_model(), "rb") as model:
        data = model.read()
    added = bytes([1 << 3 | 2, 5, 1 << 3 | 2, 1, ord("q"), 3 << 3, 4])  # a user-defined piece
    with pytest.raises(ValueError):
        piece_bpe.Model(data + added)
    cut = encoder.model.cut("▁ab1.\n▁▁c")
    assert "".join(cut) == "▁ab1.\n▁▁c" and len(cut) > 1
    assert len(piece_bpe._cutter(["b▁c", "a1"])("▁ab1▁c")) == 1  # such a piece forbids all cuts


# -- Merkle ---------------------------------------------------------------------------


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest(docs, rows, levels):
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: brute.sha("".join(map(text, r[:3])))
    root, want = brute.manifest([(r[2], r[0], leaf(r)) for r in rows])
    named = docs.withColumn("own", merkle.leaf_of([F.col(c) for c in ("doc_id", "text", "lang")]))
    found = merkle.manifest(named, "lang", ["doc_id"], digest="own", levels=levels)
    seen: dict = {}
    for r in found.withColumn("all", merkle.siblings(F.col("proof"))).withColumn("fold", merkle.folded(F.col("leaf"), F.col("proof"))).collect():
        assert r.root == r.fold == root and r.leaf == r.carried.own
        seen.setdefault((r.carried.lang, r.carried.doc_id, r.leaf), []).append((r.subroot, r.all))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}


def test_changed_leaf_does_not_fold_to_the_root(docs):
    named = docs.select("doc_id", "lang", merkle.leaf_of([F.col("doc_id"), F.col("text")]).alias("leaf"))
    found = merkle.manifest(named, "lang", ["doc_id"])
    other = merkle.folded(merkle.leaf_of([F.lit("other")]), F.col("proof"))
    assert found.filter(other == F.col("root")).count() == 0


@pytest.mark.parametrize("sizes", [[], [1], [1, 1], [8], [9], [64, 1], [4097], [1, 8, 65, 513, 4096]])
def test_trees_of_all_heights(spark, sizes):
    given = [(f"g{n}", i, brute.sha(f"{n}/{i}")) for n, size in enumerate(sizes) for i in range(size)]
    table = spark.createDataFrame(given, "lang string, doc_id int, leaf string")
    found = merkle.manifest(table, "lang", ["doc_id"]).withColumn("all", merkle.siblings(F.col("proof")))
    got = {(r.carried.lang, r.carried.doc_id, r.leaf): [(r.subroot, r["all"])] for r in found.collect()}
    if not sizes:
        assert got == {}
        return
    root, want = brute.manifest(given)
    assert got == want and {r.root for r in found.select("root").distinct().collect()} == {root}


def test_no_task_holds_a_hot_group():
    """A block is bounded whatever the group's size, and its tree is that of the whole."""
    digests = [brute.sha(str(i)) for i in range(200)]
    root, proofs = brute.folds(digests)
    height = merkle._height(200, merkle.LEVELS)
    top, runs = merkle._forward(list(enumerate(digests)), height)
    assert top == root
    found = merkle._backward(runs, height, [])
    assert ["".join(s["before"] + s["after"] for s in found[i]) for i in range(200)] == proofs
    assert merkle._height(10**12, 4) == 4 and merkle._height(1, 4) == 0 and merkle._height(9, 4) == 2


# -- fill in middle ----------------------------------------------------------------------


@pytest.mark.parametrize("unit", [fill_in_middle.TOKENS, fill_in_middle.CHARACTERS])
@pytest.mark.parametrize(("rate", "first"), [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_middles(docs, rows, unit, rate, first):
    found = fill_in_middle.transform(docs, unit=unit, rate=rate, suffix_first=first)
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    seen = found.withColumn("restored", text).collect()
    got = Counter((r.document.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in seen)
    assert got == Counter((r[0], *brute.middle_filled(r[0], r[1], unit, rate, first)) for r in rows)
    assert all(r.restored == (r.document.text or "") for r in seen)


def test_exceptions_convert_both_ways():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("ab é中😀") for _ in range(rng.randrange(50)))
        places = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
        index = fill_in_middle.Exceptions.of(np.frombuffer(text.encode(), np.uint8))
        assert index.characters(places).tolist() == list(range(len(text) + 1))
        assert index.bytes(np.arange(len(text) + 1)).tolist() == places.tolist()
        assert len(index.at) == sum(ord(c) > 127 for c in text)


def test_empty_tables(docs):
    none, path = docs.limit(0), queries.piece_model()
    assert piece_bpe.round_trip(none, path).count() == 0 and piece_bpe.encode(none, path).count() == 0
    assert fill_in_middle.transform(none).count() == 0
    assert merkle.manifest(none.withColumn("own", F.lit("x")), "lang", ["doc_id"], digest="own").count() == 0
