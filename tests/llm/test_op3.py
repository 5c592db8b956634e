import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from vitalair.llm import q03_packing as q


def test_ids_are_those_of_the_json_file(docs, odd_docs):
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = q.encoder()
    texts = [r.text or "" for r in docs.select("text").collect() + odd_docs.select("text").collect()] + ["<|endoftext|> a<|endoftext|>", "   　 x \r\n\r\n ", "'s 'LL ''''", "１２３ ½ १२३"]
    assert [encode(x) for x in texts] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_pieces_and_places(which, request):
    df = request.getfixturevalue(which)
    encode = q.encoder()
    want = []
    for r in df.collect():
        ids = np.array([*encode(r.text or ""), 0], dtype="<u4")
        rest = len(ids) % 2048
        cuts = ([0, rest] if rest else [0]) + list(range(rest + 2048, len(ids) + 1, 2048))
        want += [(r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = q.packed_documents(df).collect()
    key = lambda r: repr(r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(by) <= 1.03 * total / 2048 + 1


def test_plan_places_every_rank_once_and_pairs_large_items():
    rng = random.Random(3)
    for cap in (10, 100, 2048):
        hist = {rng.randint(1, cap): rng.randint(1, 500) for _ in range(60)}
        fill, large = {}, {}
        seen = {length: [] for length in hist}
        for length, a, b, per, first, offset in q.plan(hist, cap):
            seen[length] += range(a, b + 1)
            for r in range(a, b + 1):
                s = first + (r - a) // per
                assert fill.get(s, 0) == offset + (r - a) % per * length
                fill[s] = fill.get(s, 0) + length
                large[s] = large.get(s, 0) + (3 * length > cap)
        assert all(sorted(v) == list(range(hist[k])) for k, v in seen.items())
        assert max(fill.values()) <= cap and max(large.values()) <= 2 and set(fill) == set(range(len(fill)))


def test_real_sequences_and_empty_table(docs):
    out = q.sequences(q.packed_documents(docs, keep_ids=True)).collect()
    assert all(len(r.ids) <= 2048 and sum(s["length"] for s in r.spans) == len(r.ids) for r in out)
    assert q.packed_documents(docs.limit(0)).count() == 0


def test_places_met_by_blocks_of_ranks(docs, monkeypatch):
    """A plan too long to be sent to all tasks gives the same sequences."""
    want = sorted(map(tuple, q.packed_documents(docs).collect()), key=repr)
    monkeypatch.setattr(q, "RECORDS_TO_BROADCAST", 0)
    monkeypatch.setattr(q, "RANKS", 7)
    assert sorted(map(tuple, q.packed_documents(docs).collect()), key=repr) == want
