import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabstrata.llm import tokens

PATH = tokens.vocabulary_path()
TEXTS = [None, "", " ", "a", "Hello  world\n\n \tx", "it's we'll I'd", "naïve façade 日本語 😀👍🏽", "<|endoftext|> is text", "a" * 700, "ab" * 900, "=-" * 300 + "=" * 301, "\n" * 500, " " * 400 + "x", "é" * 200, "x" * 128, "x" * 129, "0123456789" * 40]


@pytest.fixture(scope="module")
def reference():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids if x else []


def test_fixed_texts(reference):
    assert tokens.Encoder(PATH)(TEXTS) == [reference(t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="ab =-\n'sé", max_size=200)), max_size=8))
def test_any_text(reference, texts):
    assert tokens.Encoder(PATH)(texts) == [reference(t) for t in texts]


def test_bucket_and_long_row_agree():
    v = tokens.vocabulary(PATH)
    for piece in ("a" * 90, "a" * 3000, "=-" * 700, "xyz" * 500, "abab" * 20, "tokenization" * 5, "é" * 40):
        (bucket,) = v.encode_pieces([piece])
        assert bucket.tolist() == v._long(v.byte_ids[np.frombuffer(piece.encode(), np.uint8)]).tolist()


def test_kept_pieces_are_bounded(monkeypatch, reference):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 3)
    e = tokens.Encoder(PATH)
    assert [e([t])[0] for t in TEXTS] == [reference(t) for t in TEXTS] and len(e.known) <= 8


def test_column(spark, reference):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(0, "again")], "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = tokens.encode(df, "doc_id", "text")
    assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == sorted([*((i, reference(t)) for i, t in enumerate(TEXTS)), (0, reference("again"))])
    sizes = {(r.doc_id, r.n_tokens) for r in tokens.count_tokens(df, ["doc_id"], "text").collect()}
    assert (0, 0) in sizes and (3, 1) in sizes
    assert tokens.encode(df.limit(0), "doc_id", "text").count() == 0


def test_a_vocabulary_that_would_differ_is_refused(tmp_path):
    import json

    letters = tokens.byte_letters()
    vocab = {letters[b]: b for b in range(256)} | {"abc": 256, "ab": 257}
    p = tmp_path / "v.json"
    p.write_text(json.dumps({"model": {"vocab": vocab, "merges": [["ab", "c"], ["a", "b"]]}}))
    with pytest.raises(ValueError):
        tokens.Vocabulary(str(p))


class Columns:
    """Stands for a table and gives back the function that its workers would get."""

    dtypes = [("k", "bigint"), ("t", "string")]

    def select(self, *_):
        return self

    def mapInArrow(self, f, _):
        return f


def test_workers_need_no_package(tmp_path):
    """What a worker is sent runs where this package isn't installed."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from cabstrata.llm import lookalike

    work = [tokens.encode(Columns(), "k", "t"), tokens.count_tokens(Columns(), ["k"], "t"), lookalike.canonical_texts(Columns(), "k", "t", hashed=True)]
    f = tmp_path / "f"
    f.write_bytes(cloudpickle.dumps((work, TEXTS)))
    code = """
import pickle, sys
import pyarrow as pa
work, texts = pickle.load(open(sys.argv[1], "rb"))
b = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["k", "t"])
got = [[x for out in w(iter([b, b])) for x in out.column(1).to_pylist()] for w in work]
assert "cabstrata" not in " ".join(sys.modules)
print(sum(map(len, got[0])), sum(got[1]), len(got[2]))
"""
    done = subprocess.run([sys.executable, "-c", code, str(f)], cwd=tmp_path, env={"PATH": "/usr/bin"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    n = 2 * sum(map(len, tokens.Encoder(PATH)(TEXTS)))
    assert done.stdout.split() == [str(n), str(n), str(2 * len(TEXTS))]
