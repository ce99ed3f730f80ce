import random

import numpy as np
import pyarrow as pa
import pytest

from strandlake.llm import binary as bi
from strandlake.llm import packing as pk
from strandlake.llm.tokens import WordEncoder, default_vocabulary

from .conftest import EDGES

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(default_vocabulary())


def plain(encoder, text):
    return encoder.full.encode(text or "", add_special_tokens=False).ids


def test_words_encode_as_whole_texts_do(encoder):
    rng = random.Random(1)
    letters = "aBcÉß'.,!-_ \n09²ª́ñ中<|>endoftx  \x1c\x85İº\u03a3"
    texts = ["".join(rng.choice(letters) for _ in range(60)) for _ in range(3000)]
    texts += ["", None, "<|endoftext|>, a<|startoftext|>. b", "don't I'M we'LL!!", "A.́b ,. ."] + [t for _, t in EDGES]
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(pa.array(texts))]
    assert got == [plain(encoder, t) for t in texts]


def test_memory_is_bounded(encoder, monkeypatch):
    import strandlake.llm.tokens as tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(k, k + 40)) for k in range(0, 400, 40)]
    small = WordEncoder(default_vocabulary())
    assert [x for t in texts for x in small.encode(pa.array([t]))] == encoder.encode(pa.array(texts))


@pytest.mark.parametrize("n, want", [(1, [1]), (2048, [2048]), (2049, [2048, 1]), (5000, [2048, 2048, 512, 256, 128, 8]), (7, [4, 2, 1])])
def test_piece_lengths(n, want):
    assert pk.piece_lengths(n) == want


def test_packing(spark, docs_of, encoder, edge_docs, no_docs):
    rows = pk.pack(edge_docs).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    whole: dict = {}
    for r in sorted(rows, key=lambda r: r["sequence_id"]):
        ids = np.frombuffer(r["ids"], "<u2").tolist()
        assert len(ids) == r["length"] == r["bucket"] and r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0
        assert pa.compute is not None and bi is not None
        if r["start"] == 0:
            whole.setdefault(r["doc_id"], []).append([])
        assert len(whole[r["doc_id"]][-1]) == r["start"]
        whole[r["doc_id"]][-1].extend(ids)
    texts: dict = {}
    for i, t in EDGES:
        texts.setdefault(i, []).append([*plain(encoder, t), 1])
    assert whole == texts
    assert pk.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        pk.pack(edge_docs, longest=1000)


def test_buckets(spark, docs_of, tmp_path):
    pk.write_buckets(pk.pack(docs_of([(1, "one two three four five")])), str(tmp_path / "b"))
    assert sorted(p.name for p in (tmp_path / "b").glob("bucket=*"))


@pytest.mark.parametrize("high", [1, 200, 70_000, 2**24 + 5, 2**32])
def test_variable_length_round_trip(high):
    rng = np.random.default_rng(high)
    for n in (0, 1, 3, 4, 1001):
        values = rng.integers(0, high, n, dtype=np.uint32)
        control, data = bi.encode_ranks(values)
        assert len(control) == -(-n // 4) and (bi.decode_ranks(control, data, n) == values).all()


def test_ranks_by_frequency():
    assert bi.rank_table(np.array([3, 0, 9, 3])).tolist() == [2, 0, 3, 1]


def test_files_round_trip(spark, docs_of, encoder, no_docs, tmp_path, monkeypatch):
    from zlib import crc32

    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "Of", "einheit", "é"]) for _ in range(rng.randrange(0, 40)))) for i in range(300)] + EDGES
    rng.shuffle(rows)
    path = f"file://{tmp_path}/tokens"
    back = bi.read_tokens(bi.write_tokens(docs_of(rows).repartition(5), path), path).orderBy("start").collect()
    want = sorted(((i is not None, i or 0, [*plain(encoder, t), 2]) for i, t in rows), key=lambda x: x[:2])
    at = 0
    assert len(back) == len(want)
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in back] == [w[:2] for w in want]
    by_id: dict = {}
    for _, i, ids in want:
        by_id.setdefault(i, []).append(ids)
    for r in back:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == crc32(np.array(r["ids"], "<u4").tobytes())
        by_id[r["doc_id"] or 0].remove(r["ids"])
        at += r["n_tokens"]
    empty = f"file://{tmp_path}/none"
    assert bi.read_tokens(bi.write_tokens(no_docs, empty), empty).count() == 0


def test_files_are_rolled_by_size(spark, docs_of, tmp_path):
    rows = [(i, "the of " * 550_000) for i in range(3)] + [(10 + i, f"word {i}") for i in range(5)]
    path = f"file://{tmp_path}/rolled"
    manifest = bi.write_tokens(docs_of(rows).coalesce(1), path, file_bytes=1000)
    assert manifest.count() >= 3
    back = bi.read_tokens(manifest, path, with_ids=False).orderBy("start").collect()
    assert [r["doc_id"] for r in back] == [i for i, _ in rows]
    assert [r["start"] for r in back] == np.cumsum([0, *(r["n_tokens"] for r in back)])[:-1].tolist()
    assert back[0]["n_tokens"] == 1_100_001
