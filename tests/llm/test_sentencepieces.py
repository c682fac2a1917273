import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

from recordforge.llm import sentencepieces as sp

TEXTS = [
    None, "", " ", "  ", "Hello world", " lead and trail ", "tabs\tand\n\nnew lines\n", "é ñ ü ß  x", "\U0001f600\U0001f600 mixed 漢字",
    "▁ marker ▁▁x", "a" * 3000, "x y " * 4000, "กข" * 400, "<0x0A> <s> </s> <unk>", "many      spaces" + " " * 40, "\x00\x01",
]


def random_texts(seed, n):
    rng = random.Random(seed)
    alphabet = "eeettaaoinshrdlu  \n.,THEéüñçß漢\U0001f600▁\t019"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(n)]


@pytest.fixture(scope="module")
def pieces():
    return sp.load(sp.default_path())


@pytest.fixture(scope="module")
def library(pieces, tmp_path_factory):
    """The library's own unigram search over the same pieces and scores."""
    m = pb.ModelProto()
    m.ParseFromString(open(sp.default_path(), "rb").read())
    m.trainer_spec.model_type = 1
    for i, p in enumerate(m.pieces):
        p.score = float(pieces.score[i])
    path = tmp_path_factory.mktemp("sp") / "unigram.model"
    path.write_bytes(m.SerializeToString())
    return sentencepiece.SentencePieceProcessor(model_file=str(path))


def test_trie_holds_exactly_its_words():
    rng = random.Random(3)
    words = {bytes(rng.randrange(256) for _ in range(rng.randrange(1, 6))): i for i, _ in enumerate(range(2000))}
    base, check, value = sp.double_array(words)

    def find(w):
        s = 0
        for b in w:
            t = base[s] + b
            if check[t] != s:
                return -1
            s = t
        return value[s]

    assert all(find(w) == v for w, v in words.items())
    other = [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 6))) for _ in range(2000)]
    assert all(find(w) == words.get(w, -1) for w in other)


def test_encoding_equals_the_library(pieces, library):
    texts = TEXTS + random_texts(1, 400)
    encoder = sp.Encoder(pieces)
    for part in (texts[:10], texts[10:], texts):
        ids, n = encoder.encode(part)
        at = 0
        for t, k in zip(part, n):
            assert ids[at : at + k].tolist() == library.encode(t or ""), repr(t)[:80]
            at += k


def test_alone_equals_together(pieces):
    chunks = [c.encode() for t in random_texts(2, 200) for c in sp._CHUNK.findall(sp.MARK + t.replace(" ", sp.MARK))]
    ids, n = pieces.together(chunks)
    at = 0
    for c, k in zip(chunks, n):
        assert ids[at : at + k].tolist() == pieces.alone(c).tolist()
        at += k


def test_memory_is_bounded(pieces, library, monkeypatch):
    monkeypatch.setattr(sp, "MEMORY", 20)
    encoder = sp.Encoder(pieces)
    for t in random_texts(4, 60):
        assert encoder.encode([t])[0].tolist() == library.encode(t)
        assert len(encoder.places) < 200


def test_query_and_decoding(spark, pieces, library, tmp_path):
    rows = list(enumerate(TEXTS + random_texts(5, 100))) + [(None, "no id"), (4, "Hello world")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    df.repartition(3).write.parquet(f"{tmp_path}/a/documents.parquet")
    got = sp.op9_sentencepiece(spark, f"{tmp_path}/a").collect()
    assert any(sp.MARK in t for _, t in rows if t)
    assert sorted(str((r.doc_id, r.n_pieces, r.ids)) for r in got) == sorted(str((d, len(i := library.encode(t or "")), i)) for d, t in rows)
    assert sorted(str((r.doc_id, r.n_pieces, r.round_trip)) for r in got) == sorted(str((d, len(library.encode(t or "")), sp.MARK not in (t or ""))) for d, t in rows)
    back = sp.decode(sp.encode(df, pieces), pieces).select("doc_id", "text").collect()
    assert sorted(str((r.doc_id, r.text)) for r in back) == sorted(str((d, (t or "").replace(sp.MARK, " "))) for d, t in rows)
    df.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert sp.op9_sentencepiece(spark, f"{tmp_path}/b").collect() == []


def test_texts_are_taken_by_bytes():
    import pyarrow as pa

    texts = ["é" * 5, None, "", "abc", "x" * 50, "ab", None]
    assert list(sp.slices(pa.array(texts), 12)) == [(0, 3), (3, 4), (4, 5), (5, 7)]
    assert list(sp.slices(pa.array([], pa.string()), 12)) == []
