"""Byte-pair encoding and decoding by speculation and verification.

Words that are not in the worker's memo are tokenised together:

1. *Speculate*: greedy longest match proposes tokens for each word.
2. *Verify*: a proposal is the exact encoding if and only if every adjacent token pair
   is compatible, i.e. no merge across its border could have come before the merges
   that built the two tokens. All pairs of all words are tested in one numpy pass that
   takes the tokens' border spines apart, youngest merge first.
3. *Repair*: only words with an incompatible pair are merged exactly.

The tokenizer is a ``tokenizers`` JSON file (byte-level BPE with a word-end suffix,
lower case, white space dropped), named by a path and read on the driver; its tables
have as many rows as the vocabulary and go to the executors with the task.

Defined cases: null text counts as empty and gives no ids and an empty decoded text;
very long texts are cut into blocks at white space, which no token crosses; literal
special tokens in a text become their ids; equal rows stay; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pick, ship

NO_RANK = np.iinfo(np.int64).max
# the white space of Unicode, as the inside of a character class
WHITE = r"\t-\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
BLOCK_CHARS = 1 << 20
MEMO_WORDS = 300_000
LONG_WORD = 128  # bytes from which a heap finds the next merge faster than a scan
_block_end = regex.compile(r"[\t-\r ]")


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in byte-level vocabularies, as letter -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


def _make_room(memo: dict[str, bytes], more: int) -> None:
    """Halve a memo that would grow too large; what was met first is the common half."""
    if len(memo) + more > MEMO_WORDS:
        for key in list(memo)[MEMO_WORDS // 2 :]:
            del memo[key]


class WordBpe:
    """Tables of one tokenizer, and memos of the encodings (little-endian ids) of chunks and words."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model, kinds = spec["model"], [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or model["ignore_merges"]:
            raise ValueError("not a lower-cased byte-level BPE tokenizer with word ends")
        self.suffix = model["end_of_word_suffix"] or ""
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(splitter.replace(r"[^\s", f"[^{WHITE}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special))) + ")") if self.special else None
        vocab = model["vocab"]
        size = max([*vocab.values(), *self.special.values()]) + 1
        letters = byte_letters()
        self.strings = [b""] * size
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for text, i in vocab.items():
            self.strings[i] = text.encode()
            stem = text.removesuffix(self.suffix) if self.suffix else text
            raw = bytes(letters[c] for c in stem) if all(c in letters for c in stem) else None
            if raw is not None:
                (self.final if stem != text else self.inner)[raw] = i
        for text, i in self.special.items():
            self.strings[i] = text.encode()
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.rank = np.full(size, -1)
        keys = []
        for k, pair in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab[self.strings[a].decode() + self.strings[b].decode()]
            self.left[made], self.right[made], self.rank[made] = a, b, k
            keys.append(a * size + b)
        self.size = size
        keys = np.array(keys, np.int64)
        self.pair_order = np.argsort(keys)
        self.pair_keys = keys[self.pair_order]
        self.pair_rank = dict(zip(keys.tolist(), range(len(keys))))
        self.made = np.argsort(self.rank)[-len(keys) :].tolist() if len(keys) else []  # by rank
        self.byte_token = [self.inner[bytes([b])] for b in range(256)]
        self._drop_unreachable()
        self.reach: dict[bytes, int] = {}  # longest token by its first two bytes
        for raw in [*self.inner, *self.final]:
            self.reach[raw[:2]] = max(self.reach.get(raw[:2], 1), len(raw))
        self.memo: dict[str, bytes] = {}
        self.word_memo: dict[str, bytes] = {}

    def _drop_unreachable(self) -> None:
        """Keep from proposals the tokens that merging their own bytes does not give back."""
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        sound = self.compatible(self.left[made], self.right[made], below=self.rank[made])
        good = np.ones(self.size, bool)
        for t, ok in zip(made.tolist(), sound.tolist()):
            good[t] = ok and good[self.left[t]] and good[self.right[t]]
        for table in (self.inner, self.final):
            for raw in [r for r, i in table.items() if not good[i]]:
                del table[raw]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of token pairs, NO_RANK where they do not merge."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_order[at], NO_RANK)

    def compatible(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """Whether the exact encoding keeps the border between tokens a and b (arrays).

        ``below`` gives the ranks from which the two may merge (for tokens that are made
        of a and b); by default they must never merge.
        """
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        a_until = b_until = np.full(len(at), NO_RANK) if below is None else below.astype(np.int64)
        strict = below is not None
        while len(at):
            rank = self.ranks(a, b)
            # equal merges run from the left: a's own next merge wins a tie, b's loses it
            crosses = (rank < a_until) & ((rank < b_until) if strict else (rank <= b_until)) & (rank < NO_RANK)
            ok[at[crosses]] = False
            go = ~crosses & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            at, a, b, a_until, b_until = at[go], a[go], b[go], a_until[go], b_until[go]
            undo_a = self.rank[a] > self.rank[b]
            a_until, b_until = np.where(undo_a, self.rank[a], a_until), np.where(undo_a, b_until, self.rank[b])
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            strict = False
        return ok

    def propose(self, word: bytes) -> list[int] | None:
        """Greedy longest match; None where some byte has no token."""
        out, at, n = [], 0, len(word)
        inner, final, reach = self.inner, self.final, self.reach
        while at < n:
            most = at + reach.get(word[at : at + 2], 1)
            token = final.get(word[at:]) if most >= n else None
            stop = n
            if token is None:
                for stop in range(min(n - 1, most), at, -1):
                    token = inner.get(word[at:stop])
                    if token is not None:
                        break
                else:
                    return None
            out.append(token)
            at = stop
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost among equals."""
        last = self.final if self.suffix else self.inner
        size, rank_of, made = self.size, self.pair_rank.get, self.made
        parts = [*map(self.byte_token.__getitem__, word[:-1]), last[word[-1:]]]
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        ranks = [rank_of(a * size + b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == NO_RANK:
                break
            k = ranks.index(lowest)
            parts[k] = token = made[lowest]
            del parts[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank_of(parts[k - 1] * size + token, NO_RANK)
            if k < len(ranks):
                ranks[k] = rank_of(token * size + parts[k + 1], NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merging with a heap of (rank, position) over a linked list: n log n steps."""
        n, size, rank_of, made = len(parts), self.size, self.pair_rank.get, self.made
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = [rank_of(a * size + b, NO_RANK) for a, b in zip(parts, parts[1:])] + [NO_RANK]
        heap = [(r, k) for k, r in enumerate(ranks) if r != NO_RANK]
        heapify(heap)
        while heap:
            lowest, k = heappop(heap)
            if ranks[k] != lowest:
                continue  # its pair has changed since
            parts[k] = token = made[lowest]
            gone = after[k]
            after[k] = follows = after[gone]
            parts[gone], ranks[gone], ranks[k] = -1, NO_RANK, NO_RANK
            if follows < n:
                before[follows] = k
                ranks[k] = rank_of(token * size + parts[follows], NO_RANK)
                if ranks[k] != NO_RANK:
                    heappush(heap, (ranks[k], k))
            j = before[k]
            if j >= 0:
                ranks[j] = rank_of(parts[j] * size + token, NO_RANK)
                if ranks[j] != NO_RANK:
                    heappush(heap, (ranks[j], j))
        return [token for token in parts if token >= 0]

    def encode_words(self, words: list[str]) -> None:
        """Encode new words into ``word_memo``: speculate, verify all pairs at once, repair."""
        _make_room(self.word_memo, len(words))
        raw = [w.encode("utf-8", "replace") for w in words]
        guesses = [self.propose(w) for w in raw]
        counts = np.array([len(g) if g else 0 for g in guesses], np.int64)
        flat = np.array([t for g in guesses if g for t in g], np.int64)
        owner = np.repeat(np.arange(len(words)), counts)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[back]
        wrong = set(owner[inside[~good]].tolist())
        packed, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        start = 0
        for k, (word, end) in enumerate(zip(words, ends)):
            if guesses[k] is None or k in wrong:
                self.word_memo[word] = np.array(self.merge(raw[k]), "<u4").tobytes()
            else:
                self.word_memo[word] = packed[start:end]
            start = end

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode new white-space-free chunks into ``memo``, by their words."""
        chunks = list(chunks)
        _make_room(self.memo, len(chunks))
        split = list(map(self.words.findall, chunks))
        known = self.word_memo
        fresh = {w for words in split for w in words if w not in known}
        if fresh:
            kept = {w: known[w] for words in split for w in words if w in known} if len(known) + len(fresh) > MEMO_WORDS else {}
            self.encode_words(list(fresh))
            known.update(kept)
        for chunk, words in zip(chunks, split):
            self.memo[chunk] = b"".join([known[w] for w in words])

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """White-space-free chunks of the text in blocks (lists), and special tokens (ids), in order."""
        parts = self.special_split.split(text) if self.special_split else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield self.special[part]
                continue
            start, end = 0, len(part)
            while start < end:
                found = _block_end.search(part, start + BLOCK_CHARS) if end - start > BLOCK_CHARS else None
                stop = found.start() if found else end
                block = part[start:stop]
                if not block.isascii():
                    block = unicodedata.normalize("NFC", block).replace("Σ", "σ")
                block = block.lower()
                # str.split also cuts at four control characters that are no white space here
                yield block.split() if not any(c in block for c in "\x1c\x1d\x1e\x1f") else self.words.findall(block)
                start = stop

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        split = [list(self.pieces(t)) for t in texts]
        fresh = {c for parts in split for p in parts if not isinstance(p, int) for c in p}
        fresh.difference_update(self.memo)
        if fresh:
            self.learn(fresh)
        return [self._joined(parts) for parts in split]

    def _joined(self, parts: list[list[str] | int]) -> bytes:
        out = []
        for part in parts:
            if isinstance(part, int):
                out.append(np.array([part], "<u4").tobytes())
                continue
            try:
                out.append(b"".join(map(self.memo.__getitem__, part)))
            except KeyError:  # chunks have left the memo since
                self.learn(set(part))
                out.append(b"".join(map(self.memo.__getitem__, part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Token strings joined with spaces, as a tokenizer without decoder does."""
        return b" ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()


@cache
def _model(source: str) -> WordBpe:
    return WordBpe(source)


def load(path: str) -> str:
    """The tokenizer file (its size is that of the vocabulary)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _run(model_source, columns: list[str], with_text: bool):
    """mapInArrow function: the columns of a row but its last (the text), then n_tokens, ids and, if asked for, the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_source.value)
        for batch in batches:
            for part in _slices(batch):
                ids = model.encode_all(part.columns[-1].to_pylist())
                made = [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                if with_text:
                    made.append(pa.array([model.decode(i) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=columns)

    return run


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    decoded_col: str | None = None,
) -> DataFrame:
    """Id, the ``keep`` columns, ``n_tokens`` and ``ids`` (binary: little-endian unsigned 32-bit) of every row.

    With ``decoded_col`` the text decoded from the ids is the last column, from the same pass.
    """
    ship(docs.sparkSession)
    source = docs.sparkSession.sparkContext.broadcast(load(tokenizer_path))
    rows = pick(docs, id_col, *keep, text_col)
    rows = rows.select(id_col, *keep, F.coalesce(text_col, F.lit("")).alias("t"))
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if decoded_col:
        made.append(T.StructField(decoded_col, T.StringType()))
    schema = T.StructType([*(rows.schema[c] for c in (id_col, *keep)), *made])
    return rows.mapInArrow(_run(source, schema.names, bool(decoded_col)), schema)


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text of its ids (null ids: empty text) as a last column."""
    ship(encoded.sparkSession)
    source = encoded.sparkSession.sparkContext.broadcast(load(tokenizer_path))
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())])
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(source.value)
        for batch in batches:
            for part in _slices(batch):
                texts = [model.decode(i or b"") for i in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
