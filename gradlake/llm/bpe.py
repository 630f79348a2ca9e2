"""BPE encoding by backtracking over Aho-Corasick matches, and decoding by an offset table.

A split of a piece into tokens is its BPE encoding exactly if every token encodes to itself and every two neighbours are
compatible: no merge across their border would have come before the merges inside them. So the encoder takes the longest token
at each position, checks it against its left neighbour, and goes back where nothing fits. A position that was left without
success is marked; every prefix has only one encoding, so no position is tried twice, and the time is linear in the piece.
"""

from __future__ import annotations

import json
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import map_batches, pick, slices, table

#: How byte-level tokenizers cut a text into pieces. Fixed value.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries kept per cache and Python worker (some 150 bytes each); a full cache starts anew. Pieces of texts are kept for one task only.
CACHE_ENTRIES = 1 << 19
#: Bytes of text whose tokens are held at once.
SLICE_BYTES = 4_000_000
FOREVER = 1 << 60
#: Bits of a token id in a pair.
SHIFT = 24


def default_tokenizer() -> str:
    """The installed byte-level vocabulary; executors look it up in their own installation."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, to the byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Cache(dict):
    """A bounded dictionary that computes what is missing."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class Encoder:
    """A byte-level BPE vocabulary file with its match automaton, compatibility table and offset table."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        added = spec.get("added_tokens", [])
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in added):
            raise ValueError(f"{path}: added tokens must match their plain text")
        byte_of = byte_alphabet()
        vocab = model["vocab"]
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.merges, self.parts, self.rank = {}, {}, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (vocab[t] for t in (merge.split(" ") if isinstance(merge, str) else merge))
            whole = vocab["".join(merge.split(" ") if isinstance(merge, str) else merge)]
            if whole in self.parts or max(self.rank.get(left, -1), self.rank.get(right, -1)) >= rank:
                raise ValueError(f"{path}: merge {rank} repeats a token or comes before its parts")
            self.merges[left, right], self.parts[whole], self.rank[whole] = rank, (left, right), rank
        self.edges = Cache(lambda key: self.edge(*key))
        self.compatible = Cache(lambda pair: not self.crossed(pair >> SHIFT, pair & (1 << SHIFT) - 1, FOREVER))
        self.automaton = ahocorasick.Automaton()
        own: dict[int, bool] = {}
        for i in sorted(self.bytes_of, key=lambda i: self.rank.get(i, -1)):
            left, right = self.parts.get(i, (None, None))
            own[i] = len(self.bytes_of[i]) == 1 if left is None else own[left] and own[right] and not self.crossed(left, right, self.rank[i])
            if own[i]:
                self.automaton.add_word(self.bytes_of[i].decode("latin-1"), (len(self.bytes_of[i]), i))
        self.automaton.make_automaton()
        # the next shorter token that a token begins with, or -1
        most = max(self.bytes_of) + 1
        token_of = {self.bytes_of[i]: i for i, ok in own.items() if ok}
        self.size, self.shorter = [0] * most, [-1] * most
        for token, i in token_of.items():
            self.size[i] = len(token)
            self.shorter[i] = next((token_of[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in token_of), -1)
        self.pieces = Cache(lambda piece: np.array(self.encode_piece(piece.encode()), "<u4").tobytes())
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        self.find = regex.compile(PIECES).findall
        every = self.bytes_of | {t["id"]: t["content"].encode() for t in added}
        by_id = [every.get(i, b"") for i in range(max(every) + 1)]
        self.lengths = np.array([len(b) for b in by_id], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.store = np.frombuffer(b"".join(by_id), np.uint8)

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens on one edge of ``token``, from the whole down to a byte, each with the rank of the merge that uses it up."""
        found, end = [(token, FOREVER)], FOREVER
        while token in self.parts:
            end, token = self.rank[token], self.parts[token][side]
            found.append((token, end))
        return found

    def crossed(self, left: int, right: int, before: int) -> bool:
        """True if a merge across the border comes before those inside the two tokens, and before rank ``before``.

        Equal merges go from left to right: one inside ``left`` is made first, one inside ``right`` comes too late.
        """
        merges = self.merges
        right_edge = self.edges[right, 0]
        for a, a_end in self.edges[left, 1]:
            for b, b_end in right_edge:
                rank = merges.get((a, b))
                if rank is not None and rank < a_end and rank <= b_end and rank < before:
                    return True
        return False

    def encode_piece(self, piece: bytes) -> list[int]:
        letters = piece.decode("latin-1")
        # of the matches that start at a place, the last one reported ends last
        longest = {last - length: token for last, (length, token) in self.automaton.iter(letters)}
        n, size, shorter, compatible = len(letters), self.size, self.shorter, self.compatible
        tokens: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest.get(-1, -1)
        while at < n:
            if tokens:
                left = tokens[-1] << SHIFT
                while token >= 0 and (at + size[token] in dead or not compatible[left | token]):
                    token = shorter[token]
            else:
                while token >= 0 and size[token] in dead:
                    token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at += size[token]
                token = longest.get(at - 1, -1)
            elif tokens:
                dead.add(at)
                token = tokens.pop()
                at -= size[token]
                token = shorter[token]
            else:
                raise ValueError("the vocabulary lacks bytes of the text")
        return tokens

    def encode(self, text: str) -> bytes:
        """The token ids of ``text`` as little-endian unsigned 32-bit integers."""
        lookup, find = self.pieces.__getitem__, self.find
        if self.cut is None or not any(t in text for t in self.added):
            return b"".join(map(lookup, find(text)))
        return b"".join(self.added[part] if i % 2 else b"".join(map(lookup, find(part))) for i, part in enumerate(self.cut.split(text)))

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        tokens = np.frombuffer(ids, "<u4")
        if tokens.size and tokens.max() >= len(self.lengths):
            raise ValueError("unknown token id")
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.offsets[tokens] - (ends - lengths), lengths)
        return self.store[places].tobytes().decode("utf-8", "replace")


@cache
def encoder(path: str | None) -> Encoder:
    """The encoder of a worker process, built once."""
    return Encoder(path or default_tokenizer())


def encode(df: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: str | None = None, decoded: bool = False) -> DataFrame:
    """Encode every whole text: the id column, ``n_tokens`` and ``token_ids`` (packed little-endian unsigned 32-bit integers).

    ``decoded`` adds the text that the ids decode to. A null text counts as empty and has no tokens; ids are passed on as they
    are, null and repeated ones too; every input row gives one row. Other columns are left out, whatever their names.
    ``tokenizer`` is a vocabulary file that every executor can open (by default the installed public one).
    """
    rows = pick(df, **{"row": id_column, "text": text}).withColumn("text", F.coalesce("text", F.lit("")))
    kind = rows.schema["row"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(tokenizer)
        packed, texts = [], []
        for value in batch.column(1):
            packed.append(own.encode(value.as_py()))
            if decoded:
                texts.append(own.decode(packed[-1]))
        columns = [batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())]
        names = [id_column, "n_tokens", "token_ids"]
        if decoded:
            columns, names = [*columns, pa.array(texts, pa.string())], [*names, "decoded"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run_sliced(batches):
        try:
            for batch in batches:
                for start, end in slices(pc.binary_length(batch.column(1)).to_pylist(), SLICE_BYTES):
                    yield run(batch.slice(start, end - start))
        finally:
            # the worker goes on to tasks of other operators
            encoder(tokenizer).pieces.clear()

    return rows.mapInArrow(run_sliced, f"`{id_column}` {kind}, n_tokens bigint, token_ids binary" + ", decoded string" * decoded)


def decode(df: DataFrame, id_column: str = "doc_id", token_ids: str = "token_ids", tokenizer: str | None = None) -> DataFrame:
    """The text of packed token ids; null ids count as none."""
    rows = pick(df, **{"row": id_column, "ids": token_ids})
    kind = rows.schema["row"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(tokenizer)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(v.as_py() or b"") for v in batch.column(1)], pa.string())], [id_column, "decoded"])

    return map_batches(rows, run, f"`{id_column}` {kind}, decoded string")


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Row digests of :func:`encode` with ``decoded``."""
    return encoded.select(id_column, "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    return digests(encode(table(spark, sf_dir, "documents"), decoded=True))
