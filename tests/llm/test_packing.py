"""Every id in exactly one piece, sequences without gaps, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from barlake.llm import packing
from barlake.llm.bpe import default_tokenizer, encoder
from barlake.llm.queries import QUERIES


def document_ids(text):
    from tokenizers import Tokenizer

    tok = document_ids.__dict__.setdefault("tok", Tokenizer.from_file(default_tokenizer()))
    return [*tok.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, docs, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for doc, texts in docs.items():
        ids = document_ids(texts[0])
        want = np.array(ids, dtype="<u4")
        got = sorted(by_doc.pop(doc), key=lambda p: (p["start"], p["sequence_id"]))
        assert sum(p["length"] for p in got) == len(ids) * len(texts)
        for copy in range(len(texts)):
            at = 0
            for p in got[copy::len(texts)]:
                assert (p["start"], p["doc_tokens"]) == (at, len(ids))
                at += p["length"]
                assert p["ids_crc32"] == zlib.crc32(want[p["start"]:at].tobytes())
            assert at == len(ids)
    assert not by_doc
    waste = total = 0
    for some in by_seq.values():
        at = 0
        for p in sorted(some, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= capacity
        waste += 0 if at & (at - 1) == 0 else capacity - at
        total += at
    return waste / (total + waste)


def test_query(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    padding = check(QUERIES["op2_harmonic_packing"](spark, sf_small).collect(), {r["doc_id"]: [r["text"]] for r in rows}, 2048)
    assert padding < 0.03


def test_edge_rows_and_sequences(spark):
    rows = [(1, None), (2, ""), (3, "long " * 5000), (4, "twice"), (4, "twice"), (5, "<|endoftext|> in  text \n"), (6, " ")]
    df = spark.createDataFrame([(d, t, 9, 9) for d, t in rows], "doc_id long, text string, class int, length int")
    packed = packing.pack_documents(df, capacity=64, with_ids=True)
    docs = defaultdict(list)
    for d, t in rows:
        docs[d].append(t)
    pieces = packed.drop("ids").collect()
    check(pieces, docs, 64)
    seqs = packing.sequences(packed, 64).collect()
    assert {len(s["ids"]) for s in seqs} <= {1, 2, 4, 8, 16, 32, 64}
    assert sum(s["n_tokens"] for s in seqs) == sum(len(document_ids(t)) for _, t in rows)


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_cuts_fit_their_class(capacity):
    for n in (1, 2, 3, capacity - 1, capacity, capacity + 1, 5 * capacity + 3):
        cut = packing.cut_lengths(n, capacity) if n > 0 else []
        assert sum(cut) == max(n, 0)
        assert all(1 <= x <= capacity and x * (capacity // x) <= capacity for x in cut)


def test_pieces_of_odd_white_space_match_the_library():
    from tokenizers import Tokenizer

    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "\n", "x<|endoftext|> y", "x <|endoftext|>  z ",
             "tab\t x", "a  b", " em  x", "é  è  ñ", "a\x1c b", "a \x1cb!\x1c c", "'s 't don't  ", "日本 語　テ",
             " \t\n x\n\n y ", "don't we're I'll", "1 22 333 4a b5", "🙂 🙂🙂  !", "a  b"]
    tok = Tokenizer.from_file(default_tokenizer())
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(default_tokenizer()).encode(texts)] == want
