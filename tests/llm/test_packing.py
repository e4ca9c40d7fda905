"""Packing against the tokenizer itself, plain Python for pieces and places, and exhaustive search on a few pieces."""

import random
import struct
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers as files
import pyarrow as pa
from tokenizers import Tokenizer

from weftline.llm.common import chunks
from weftline.llm.packing import Encoder, Packer, pack

SCHEMA = "doc_id long, text string, length int, uid string, sequence_id string"


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def texts(rng):
    bits = ["a", "The", "don't", "é", "日本語", "😀", " ", "  ", "\n", "\t", "\x1d", " ", " ", "　", "12", "...", "it's", "<|endoftext|>", "<|endof", "naïve", "_x_", "'", "\r\n"]
    out = [None, "", " ", "\n", "  ", " a", "a ", "a  b", "a \n b", "<|endoftext|>", "x<|endoftext|> y"]
    out += ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(60))) for _ in range(400)]
    return out + [" ".join(rng.choice(bits[:6]) for _ in range(n)) for n in (1023, 1024, 1025, 4000, 9000)]


def test_ids_equal_the_tokenizers():
    rng = random.Random(1)
    rows = texts(rng)
    tokenizer = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    batch = pa.RecordBatch.from_pydict({"text": pa.array(rows, pa.string())})
    for limit, most in ((500, 40), (1 << 20, 1_000_000)):  # also with a table that has to start anew again and again
        encode = Encoder(most)
        got = [x for _, data, bounds in chunks(iter([batch]), limit=limit) for x in encode(data, bounds)]
        assert [x.tolist() for x in got] == [ids_of(tokenizer, t)[:-1] for t in rows]


def test_pieces_and_places(spark):
    rng = random.Random(2)
    rows = [(i, t, 1, "u", "s") for i, t in enumerate(texts(rng))] + [(3, "the same row", 1, "u", "s")] * 3 + [(None, "no id", None, None, None)]
    tokenizer = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    want = []
    for doc, text, *_ in rows:
        ids = ids_of(tokenizer, text)
        first = len(ids) % 1024 or 1024
        for k, end in enumerate(range(first, len(ids) + 1, 1024)):
            start = 0 if k == 0 else end - 1024
            want.append((doc, k, start, end - start, zlib.crc32(struct.pack(f"<{end - start}I", *ids[start:end]))))
    out = pack(spark.createDataFrame(rows, SCHEMA), shard_pieces=100).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=str) == sorted(want, key=str)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    lengths = [n for *_, n, _ in want]
    assert len(bins) <= -(-sum(lengths) // 1024) + 1
    assert pack(spark.createDataFrame([], SCHEMA)).collect() == []


def fewest(lengths, size):
    @lru_cache(None)
    def need(left):
        if not left:
            return 0
        best = len(left)
        first, rest = left[0], left[1:]
        for mask in range(1 << len(rest)):
            mates = [x for k, x in enumerate(rest) if mask >> k & 1]
            if first + sum(mates) <= size:
                best = min(best, 1 + need(tuple(x for k, x in enumerate(rest) if not mask >> k & 1)))
        return best

    return need(tuple(sorted(lengths, reverse=True)))


def test_small_sets_against_exhaustive_search():
    rng = random.Random(3)
    over = decreasing = 0
    for k in range(60):
        lengths = [rng.randrange(10, 60) for _ in range(8)]
        best = fewest(tuple(lengths), 100)
        packer = Packer(lengths, 100, k)
        bins = packer.evolve([], 4, 6)
        assert sorted(i for b in bins for i in b) == list(range(8)) and max(map(packer.fill, bins)) <= 100
        over, decreasing = over + len(bins) - best, decreasing + len(packer.first(0.0)) - best
    assert over <= decreasing and over <= 2


def test_evolution_beats_best_fit_decreasing():
    """On lengths that best-fit decreasing packs loosely; a lower bound says what more could be had."""
    rng = random.Random(4)
    start = end = bound = 0
    for k in range(6):
        lengths = np.clip(np.array([int(rng.triangular(150, 700, 300)) for _ in range(600)]), 1, 1023).tolist()
        packer = Packer(lengths, 1024, k)
        elite = packer.first(0.0)
        start += len(elite)
        for _ in range(3):
            elite = packer.evolve([elite], 4, 6)
        end, bound = end + len(elite), bound + packer.least
    print("best-fit decreasing", start, "evolved", end, "bound", bound)
    assert end < start
