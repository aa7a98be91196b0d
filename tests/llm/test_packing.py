from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import odd_rows
from tierline.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODE = P.Encoder(PATH)


def whole(text):
    return ENCODE.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aAbzéÉßÿ×÷µªºİıſ 's'tdl.,;:!?-_́̈\x1c\x1f\x85\xa0 \n\t012½日本한🙂<|>"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_of_runs_are_ids_of_the_text(text):
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == whole(text)


def test_special_names_and_forgetting(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 2)
    for text in ("a<|endoftext|>b", "I'll can't THE End.", "<|startoftext|> x", "é" * 50, ""):
        assert np.frombuffer(ENCODE(text), "<u4").tolist() == whole(text)


def valid(plan, counts, capacity):
    used, items = Counter(), Counter()
    spans = {}
    for length, rank, first, copies, offset in plan.placed:
        after = [p for p in plan.placed if p[0] == length and p[1] > rank]
        n = min((p[1] for p in after), default=counts[length]) - rank
        items[length] += n
        for k in range(n):
            spans.setdefault(first + k // copies, []).append((offset + k % copies * length, length))
            used[first + k // copies] += length
    assert items == Counter(counts)
    for at in spans.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(spans) == plan.sequences
    return plan.sequences


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), max_size=25))
def test_plans_are_gapless_and_hold_each_piece_once(counts):
    n = valid(P.Plan(counts, 60), counts, 60)
    total = sum(k * c for k, c in counts.items())
    large = sum(c for k, c in counts.items() if 2 * k > 60)
    least = max(-(-total // 60), large)
    assert n <= 1.5 * least + 1


def test_large_pieces_pair_at_most_twice_and_small_ones_fill():
    plan = P.Plan({50: 2, 30: 3, 25: 1, 10: 2, 5: 1}, 60)
    assert valid(plan, {50: 2, 30: 3, 25: 1, 10: 2, 5: 1}, 60) == 4


def test_rows_round_trip(documents, spark):
    rng = random.Random(2)
    rows = odd_rows() + [(100 + k, " ".join(rng.choice(["alpha", "be", "ga"]) for _ in range(rng.randrange(1, 200)))) for k in range(200)] + [(900, "hot copy")] * 300
    pieces = P.pieces(documents(rows), capacity=128, keep_ids=True)
    packed = P.pack(pieces, 128)
    got = packed.collect()
    want = Counter()
    for key, text, *_ in rows:
        ids = [*whole(text or ""), P.END]
        for k, at in enumerate(range(0, len(ids), 128)):
            want[key, k, at, len(ids[at : at + 128]), zlib.crc32(np.array(ids[at : at + 128], "<u4").tobytes())] += 1
    assert Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert "offset" in packed.columns and P.sequences(packed).count() == len({r["sequence_id"] for r in got})
    for r in P.sequences(packed).collect():
        assert r["ids"] == [i for p in sorted((p for p in got if p["sequence_id"] == r["sequence_id"]), key=lambda p: p["offset"]) for i in p["ids"]]
        assert len(r["ids"]) <= 128
    assert len({r["sequence_id"] for r in got}) <= -(-sum(r["length"] for r in got) // 128) + 1


def test_empty_table(documents):
    assert P.pack(P.pieces(documents([]))).count() == 0
