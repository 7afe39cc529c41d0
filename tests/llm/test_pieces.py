import random
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import pieces as p

MODEL = p.default_model()


@pytest.fixture(scope="module")
def model():
    return p.model_of(MODEL)


def chunked(model, text, chunk):
    line = " " + text.replace(p.SPACE, " ")
    parts = []
    for s in range(0, len(line), chunk):
        lo = max(0, s - model.longest)
        parts.append((line[lo : s + chunk + model.longest], s - lo, min(s + chunk, len(line)) - lo))
    matrices = [model.transfer(t, s, e, i == 0) for i, (t, s, e) in enumerate(parts)]
    states = p.boundary_states(matrices)
    return [i for (t, s, e), x, y in zip(parts, states, states[1:]) for i in model.backtrace(t, s, e, x, y)], matrices


def texts():
    rng = random.Random(1)
    made = ["".join(rng.choices("abcdefghinortse 1é日\n", k=rng.randint(1, 150))) for _ in range(60)]
    made += ["".join(rng.choices("etaoinshr", k=120)) for _ in range(15)]
    return [*made, "a" * 100, "  " * 40, " " * 33 + "x", "hellohello" * 20, "x", " ", "\n", "a \n b", f"q{p.SPACE}r", "日本語テキスト 😀"]


def test_whole_texts_as_the_library(model):
    for t in [*texts(), "", None]:
        assert np.frombuffer(model.encode(t), "<u2").tolist() == model.library.encode(t or "")


def test_batches_as_the_library(model):
    rng = random.Random(4)
    some = [*texts(), "", "a, b.", "\na,\nb. ", "x(", "é). q", "a ", "a \n", "\n\n", "a\t,b"]
    some += ["".join(rng.choices(f"abé日 \n.,;(){p.SPACE} ", k=rng.randint(1, 40))) for _ in range(500)]
    got = model.batch(pa.array(some))
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [model.library.encode(t) for t in some]


def test_new_words_go_to_the_library_once_and_in_one_call():
    calls, fresh = [], p.Pieces(MODEL)

    class Library:
        def encode(self, found, **_):
            calls.append(found)
            return p.model_of(MODEL).library.encode(found)

    fresh.library = Library()
    fresh.batch(pa.array(["one two, two. two", "two; one", "two"] * 50))
    assert len(calls) == 1 and sorted(calls[0]) == ["a,", "a.", "a;", "one", "two"]
    fresh.batch(pa.array(["two. one"]))
    assert len(calls) == 1


def test_chunks_as_the_library(model):
    for t in texts():
        for chunk in (1, 4, 50):
            assert chunked(model, t, chunk)[0] == model.library.encode(t), (t, chunk)


def test_matrices_combine_associatively(model):
    for t in texts()[60:75]:
        matrices = chunked(model, t, 20)[1]
        left = reduce(p.compose, matrices)
        right = reduce(lambda a, b: p.compose(b, a), matrices[::-1])
        assert {x: set(y) for x, y in left.items()} == {x: set(y) for x, y in right.items()}
        assert any(s[0] == 0 for s in left[p.START])


def test_operator_with_giant_texts(spark, model):
    rng = random.Random(2)
    words = ["alpha", "beta,", "Gamma", "delta\n", "nä", "日本"]
    giant = " ".join(rng.choices(words, k=3000))
    solid = "".join(rng.choices("etaoinshrdlu", k=2500))
    rows = [(1, "short text"), (2, None), (3, ""), (4, giant), (5, giant), (6, solid), (None, giant), (4, giant), (7, giant[:511]), (8, giant[:512]), (9, giant[:513])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    coded = p.encode(docs, MODEL, chunk=512, fan=3)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32, r.decoded_crc32, r.round_trip) for r in p.digest(docs, MODEL, chunk=512, fan=3).collect())
    want = []
    for i, t in rows:
        ids = model.library.encode(t or "")
        want.append((-1 if i is None else i, len(ids), crc32(np.array(ids, "<u4").tobytes()), crc32((t or "").encode()), True))
    assert got == sorted(want)
    back = {r.doc_id: r.text for r in p.decode(coded, MODEL).collect()}
    assert back[6] == solid and back[1] == "short text" and back[2] == ""
    assert p.digest(docs.limit(0), MODEL).count() == 0


def test_a_text_of_five_million_characters(spark, model):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(5000)] + ["\n", "日本", "x" * 300]
    text = " ".join(rng.choices(words, k=800_000))
    assert len(text) > 4_500_000
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u2") for r in p.encode(docs, MODEL).collect()}
    assert got[1].tolist() == model.library.encode(text)
    assert model.decode(got[1]) == text.encode()
