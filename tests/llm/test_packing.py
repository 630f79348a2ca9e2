"""Packing against the tokenizers library and best fit over single pieces."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest

from gradlake.llm import bpe, packing
from tests.llm.test_llm import ODD, SF_DIR, empty, odd, table  # noqa: F401


def brute_best_fit(lengths, room):
    """Best-fit-decreasing piece by piece: the number of sequences."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= n
        else:
            left.append(room - n)
    return len(left)


@pytest.mark.parametrize("room", [1, 2, 7, 50, 333])
def test_plan_equals_best_fit_over_pieces(room):
    rng = random.Random(room)
    for _ in range(60):
        lengths = [rng.choice([rng.randint(1, room), max(1, room // 3), min(room, 2)]) for _ in range(rng.randint(0, 160))]
        counts = Counter(lengths)
        steps = packing.best_fit(counts, room)
        filled = defaultdict(list)
        for length, n in counts.items():
            own = sorted(s for s in steps if s[0] == length)
            for rank in range(n):
                _, first, sequence, each, offset = [s for s in own if s[1] <= rank][-1]
                filled[sequence + (rank - first) // each].append((offset + (rank - first) % each * length, length))
        for places in filled.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= room
        assert sorted(length for own in filled.values() for _, length in own) == sorted(lengths)
        assert len(filled) == brute_best_fit(lengths, room)


def test_steps_do_not_grow_with_counts():
    rng = random.Random(1)
    lengths = {n: rng.randint(1, 50) for n in range(1, 2049)}
    few = len(packing.best_fit(lengths))
    many = len(packing.best_fit({n: c * 10**9 for n, c in lengths.items()}))
    assert few < 400_000 and many < 400_000
    with pytest.raises(ValueError):
        packing.best_fit({2049: 1})


def check(rows, found, room):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(bpe.default_tokenizer())
    want, lengths = Counter(), []
    for i, text in rows:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % room or room
        edges = [0, *range(first, len(ids) + 1, room)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            want[i, piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
            lengths.append(b - a)
    assert Counter(tuple(r)[:5] for r in found) == want
    filled = defaultdict(list)
    for r in found:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= room
    assert len(filled) == brute_best_fit(lengths, room)


def test_documents_are_packed_whole(spark, odd, empty):  # noqa: F811
    rows = [*ODD, (8, "<|endoftext|> and 't <|endoftext|>"), (9, "a\x1cb \x85᠎　x  y\n\n z"), (10, "ﬁ ١٢ ²½ 🙂‍👨 é"), *((20, "copy of one text"),) * 400]
    for room in (5, 64, 2048):
        check(rows, packing.pack(table(spark, rows).repartition(7), room=room).collect(), room)
    assert packing.pack(empty).count() == 0
    with_ids = packing.pack(odd, with_ids=True).collect()
    assert all(zlib.crc32(r["token_ids"]) == r["ids_crc32"] and len(r["token_ids"]) == 4 * r["length"] for r in with_ids)


def test_latin_texts_are_cut_alike():
    own, rng = packing.ids_of(None), random.Random(2)
    signs = [chr(c) for c in range(0x20, 0x100) if not packing.re.search(packing.NOT_LATIN, chr(c))] + ["\n", "\t", "\r", " ", "  ", "'", "'s", "'ll", "ab", "12"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 30)))
        assert own.odd(text) is None and own.find(text) == own.find_latin(text)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = packing.op12_packing(spark, SF_DIR)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(docs, found.collect(), 2048)
