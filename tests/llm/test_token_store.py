import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarterdeck.llm import token_store as ts
from quarterdeck.llm.wavelet import WaveletMatrix

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_wavelet_matrix(n):
    values = np.random.default_rng(n).integers(0, 40, n).astype(np.uint16)
    w = WaveletMatrix.from_bytes(WaveletMatrix.of(values, 6).to_bytes())
    at = np.arange(n)
    assert (w.decode() == values).all() and (w.access(at) == values).all()
    for v in (0, 7, 39, 50):
        where = np.flatnonzero(values == v)
        assert w.count(v) == len(where) and w.occurrences(v).tolist() == where.tolist()
        ends = np.arange(n + 1)
        assert w.rank(np.full(n + 1, v), ends).tolist() == [int((values[:i] == v).sum()) for i in ends]


ENCODER = ts.Encoder(PATH)
SPECIAL = ["<|endoftext|>", "a\n <|endoftext|> b", "x<|endoftext|>y z", "one  <|endoftext|>", "<|endoftext|> hi. there"]


def plain(texts, special_as_text=False):
    t = Tokenizer.from_file(PATH)
    if special_as_text:
        t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]


ODD = ["", "  ", " a", "a ", "\n", "a\n\nb", "x\n y", "l'été don't s'il", "naïve, über... straße\nÉcole。日本語 テスト", "a1 b2 3c", "🙂 🙂x", "|a | b |", "ab.,.,c d.,", "\ta b", "a b c　d", "ﬁ ½ ² ª º x", "<|endoftext|> hi", "A.\nB,\nC", "word. word, word.\nWord", None]


def listed(encoder, texts):
    """Ids of each text, encoded together and once more as a slice of a longer array."""
    ids, bounds = encoder(pa.array(texts, pa.string()))
    sliced, cut = encoder(pa.array(["lead in", *texts], pa.string())[1:])
    assert sliced.tolist() == ids.tolist() and cut.tolist() == bounds.tolist()
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


@pytest.mark.parametrize("special_as_text", [False, True])
def test_encoder_is_the_tokenizer(special_as_text):
    found = listed(ts.Encoder(PATH, special_as_text), ODD + SPECIAL)
    assert found == [p[:-1] for p in plain(ODD + SPECIAL, special_as_text)]
    assert listed(ts.Encoder(PATH), []) == []


@given(st.lists(st.text(st.sampled_from("aé日 \n\t.,'1-s") | st.characters(codec="utf-8"), max_size=12), max_size=8))
@settings(max_examples=200, deadline=None)
def test_encoder_on_random_texts(texts):
    assert listed(ENCODER, texts) == [p[:-1] for p in plain(texts)]


def test_matrix_opens_few_blocks(monkeypatch):
    monkeypatch.setattr("quarterdeck.llm.wavelet.BLOCK_WORDS", 4)
    values = np.random.default_rng(1).integers(0, 500, 20_000).astype(np.uint16)
    w = WaveletMatrix.from_bytes(WaveletMatrix.of(values, 9).to_bytes())
    assert w.access(np.array([17, 18, 9_000])).tolist() == values[[17, 18, 9_000]].tolist()
    opened = sum(int((~p.missing).sum()) for p in w.planes)
    assert opened < 0.2 * sum(len(p.blocks) for p in w.planes)
    assert w.occurrences(7).tolist() == np.flatnonzero(values == 7).tolist()
    assert (w.decode() == values).all()


def test_round_trip(spark, tmp_path):
    rows = [(k * 3 - 10, t) for k, t in enumerate(ODD * 3)] + [(500, "a long one " * 5000), (None, "no id")]
    rows.append(rows[4])  # a repeated row
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = ts.encode_and_read(df, PATH, str(tmp_path / "t"), shard_tokens=50).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = plain([t for _, t in order])
    starts = np.cumsum([0, *map(len, ids)])[:-1]
    expected = [(i, int(s), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), s, x in zip(order, starts, ids)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))

    shards = ts.read_shards(spark, str(tmp_path / "t"))
    whole = [t for x in ids for t in x]
    assert sorted(r.position for r in ts.token_positions(shards, 0).collect()) == [i for i, t in enumerate(whole) if t == 0]
    assert [tuple(r) for r in ts.tokens_at(shards, 40, 160).orderBy("position").collect()] == list(enumerate(whole))[40:160]
    counts = {r.token_id: r.n for r in ts.token_counts(shards, [0, whole[0], 50000]).collect()}
    assert counts == {t: whole.count(t) for t in {0, whole[0], 50000}}


def test_rows_that_share_an_id_and_clashing_columns(spark, tmp_path):
    rows = [(1 if k % 3 else None, f"text {k}", k, k, "m") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, part int, matrix string")
    found = [ts.encode_and_read(df.repartition(n), PATH, str(tmp_path / f"r{n}"), shard_tokens=30).drop("p").orderBy("start").collect() for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == 40
    assert [r.start for r in found[0]] == np.cumsum([0, *(r.n_tokens for r in found[0])])[:-1].tolist()


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ts.encode_and_read(df, PATH, str(tmp_path / "t")).count() == 0


def test_query_and_pipeline_use_the_plain_call(spark, tmp_path):
    import corpus_pipeline

    from quarterdeck.llm import queries

    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    t, start, expected = Tokenizer.from_file(PATH), 0, []
    for k, x in enumerate(SPECIAL):
        ids = [*t.encode(x, add_special_tokens=False).ids, 0]
        expected.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    for out in (queries.op4_wavelet_tokens(spark, str(tmp_path)), corpus_pipeline.write_tokens(spark, docs, str(tmp_path))):
        assert sorted(map(tuple, out.collect())) == expected
