"""Exact token counts at every prefix of a text, by dynamic programming over last tokens."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
CACHE = 400_000
#: What ``\\s`` matches in the vocabulary's pattern, which leaves out U+001C to U+001F.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Of three characters: only the whole is one piece.
CONTRACTIONS = ("'re", "'ve", "'ll")


@functools.cache
def encoding(path: str):
    """The byte-level vocabulary beside ``path`` (``x.json`` and ``x.tiktoken`` hold the same ids).

    tiktoken gives the ids of the tokenizers library for this vocabulary (the tests compare the
    two, special strings and odd characters included) at about four times its speed.
    """
    import public_tokenizers
    import tiktoken

    with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def token_ids(path: str, text: str) -> np.ndarray:
    """The text's ids as the library's default gives them: the special string is one id."""
    enc, _ = encoding(path)
    parts = text.split(SPECIAL)
    if len(parts) == 1:
        return enc.encode_to_numpy(text, disallowed_special=())
    out: list[np.ndarray] = []
    for i, part in enumerate(parts):
        if i:
            out.append(np.array([SPECIAL_ID], np.uint32))
        out.append(enc.encode_to_numpy(part, disallowed_special=()))
    return np.concatenate(out)


@functools.cache
def counter(path: str) -> PrefixCounter:
    """One counter for each worker process: its tables serve the tasks that follow."""
    return PrefixCounter(path)


class PrefixCounter:
    """Token counts at every code point prefix of a text.

    For a byte-pair vocabulary, the encoding of a prefix that ends at byte i ends in exactly one
    token t, and count[i] = count[i - len(t)] + 1; t is the vocabulary's suffix of the prefix that
    may follow the last token at i - len(t), which holds if and only if the two tokens encode to
    themselves when joined. The state of each prefix of a word is kept, so words that begin
    alike share it. A text is cut into units (white space and the word after it), whose counts,
    as differences from one code point to the next, are kept and laid end to end.
    """

    def __init__(self, path: str, cache: int = CACHE):
        import regex

        self.enc, self.ranks = encoding(path)
        self.most, self.longest = cache, max(map(len, self.ranks))
        self.state: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.joins: dict[tuple[bytes, bytes], bool] = {}
        self.rows: dict[str, bytes] = {}
        # a contraction, a word, or white space with the word that follows it
        self.units = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
            r"|\s+(?:\p{L}+|\p{N}+|(?<! )'(?:s|t|re|ve|m|ll|d)|[^\s\p{L}\p{N}]+)?"
        )

    def _follows(self, a: bytes, b: bytes) -> bool:
        key = (a, b)
        found = self.joins.get(key)
        if found is None:
            if len(self.joins) > self.most:
                self.joins.clear()
            r = self.ranks
            found = self.joins[key] = self.enc._encode_single_piece(a + b) == [r[a], r[b]]
        return found

    def _row(self, raw: bytes) -> tuple[int, bytes, bytes]:
        """Count, last token, and the count's steps (int8) at each byte of an encoded piece,
        from the longest prefix with a known state on."""
        state, ranks, joins = self.state, self.ranks, self.joins
        found = state.get(raw)
        if found:
            return found
        n = len(raw)
        i = n - 1
        while i and raw[:i] not in state:
            i -= 1
        count, last, steps = state[raw[:i]] if i else (0, b"", b"")
        while i < n:
            i += 1
            p = raw[:i]
            if p in ranks:
                new = 1
                last = p
            else:
                for j in range(max(1, i - self.longest), i):
                    t = p[j:]
                    if t in ranks:
                        before = state[p[:j]]
                        ok = joins.get((before[1], t))
                        if ok or ok is None and self._follows(before[1], t):
                            new, last = before[0] + 1, t
                            break
            steps += bytes(((new - count) & 255,))
            count = new
            state[p] = (count, last, steps)
        return state[raw]

    def _long(self, piece: str) -> list[int]:
        """The same for a piece too long to keep a state for each prefix as bytes."""
        raw = piece.encode()
        count, last = [0] * (len(raw) + 1), [b""] * (len(raw) + 1)
        for i in range(1, len(raw) + 1):
            for j in range(max(0, i - self.longest), i):
                t = raw[j:i]
                if t in self.ranks and (j == 0 or self._follows(last[j], t)):
                    count[i], last[i] = count[j] + 1, t
                    break
        ends = np.cumsum([len(c.encode()) for c in piece])
        return [count[e] for e in ends]

    def _piece(self, piece: str) -> list[int]:
        if len(piece) > 64:
            return self._long(piece)
        raw = piece.encode()
        counts, at = [], 0
        for x in self._row(raw)[2]:
            at += x - 256 if x > 127 else x
            counts.append(at)
        if len(raw) == len(piece):
            return counts
        ends, at = [], -1
        for c in piece:
            at += 1 if c < "\x80" else len(c.encode())
            ends.append(counts[at])
        return ends

    def _unit(self, unit: str) -> bytes | np.ndarray:
        """Steps of the count at each code point of a unit, as int8 where they fit."""
        if len(self.state) > 2 * self.most:
            self.state.clear()
        core = unit.lstrip(SPACES)
        space = unit[: len(unit) - len(core)]
        if not core:
            counts = self._piece(space)
        elif space in ("", " ") and len(unit) <= 64 and unit.isascii() and unit not in CONTRACTIONS:
            return self._row(unit.encode())[2]
        elif not space:
            counts = self._word(unit)
        elif space[-1] == " ":  # the last blank belongs to the word
            rest, joined = space[:-1], self._piece(" " + core)
            head = self._piece(rest) if rest else []
            counts = head + [self._piece(space)[-1]] + [(head[-1] if head else 0) + x for x in joined[1:]]
        else:
            rest = space[:-1]
            head = self._piece(rest) if rest else []
            base = (head[-1] if head else 0) + self._piece(space[-1])[-1]
            counts = head + [self._piece(space)[-1]] + [base + x for x in self._word(core)]
        steps = [b - a for a, b in zip([0, *counts], counts, strict=False)]
        if max(steps) > 127 or min(steps) < -128:
            return np.array(steps, np.int32)
        return bytes(x & 255 for x in steps)

    def _word(self, word: str) -> list[int]:
        if word in CONTRACTIONS:  # its first two characters alone are no contraction
            return [1, 2, self._piece(word)[-1]]
        return self._piece(word)

    def _plain(self, text: str) -> np.ndarray:
        """Steps of the count at each code point."""
        rows = self.rows
        out = []
        plain = True
        for u in self.units.findall(text):
            row = rows.get(u)
            if row is None:
                row = self._unit(u)
                if not isinstance(row, bytes):
                    plain = False
                elif len(u) <= 64:
                    if len(rows) > self.most:
                        rows.clear()
                    rows[u] = row
            out.append(row)
        if plain:
            return np.frombuffer(b"".join(out), np.int8)
        return np.concatenate([np.frombuffer(x, np.int8) if isinstance(x, bytes) else x for x in out])

    def counts(self, text: str) -> np.ndarray:
        """count[i]: tokens of text[:i], for i from 0 to len(text)."""
        out = np.zeros(len(text) + 1, np.int32)
        at, base = 0, 0
        parts = text.split(SPECIAL)
        for i, part in enumerate(parts):
            closed = i < len(parts) - 1
            # the special string, while it is incomplete, is ordinary text
            part_counts = self._plain(part + SPECIAL[:-1] if closed else part).cumsum(dtype=np.int32)
            out[at + 1 : at + 1 + len(part_counts)] = base + part_counts
            if closed:
                whole = int(part_counts[len(part) - 1]) if part else 0
                at += len(part) + len(SPECIAL)
                base += whole + 1
                out[at] = base
        return out


def within(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) if len(fits) else 0


def prefix_counts(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", budget: int = 1024, keep: bool = False
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fits_chars`` and, with ``keep``, ``counts``.

    ``counts[i]`` is the exact number of tokens of the first i code points; ``fits_chars`` is the
    length of the longest prefix within ``budget``. Both are read off the prefix table, the text
    is not encoded again. Null texts count as empty; ids may be null or repeat (one row each);
    no rows give no rows. Other columns are not read.
    """
    fields = [pa.field("doc_id", pa.int64()), pa.field("n_bytes", pa.int64()), pa.field("n_tokens", pa.int64())]
    fields += [pa.field("over_limit", pa.bool_()), pa.field("fits_chars", pa.int64())]
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fits_chars long"
    if keep:
        fields.append(pa.field("counts", pa.list_(pa.int32())))
        schema += ", counts array<int>"
    out = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(tokenizer)
        for batch in batches:
            n_bytes, n_tokens, over, fits, kept = [], [], [], [], []
            for x in batch.column(1):
                text = x.as_py() or ""
                c = table.counts(text)
                n_bytes.append(len(text) if text.isascii() else len(text.encode()))
                n_tokens.append(int(c[-1]))
                over.append(bool(c[-1] > budget))
                fits.append(len(text) if c.max() <= budget else within(c, budget))
                if keep:
                    kept.append(c)
            cols = [batch.column(0).cast(pa.int64()), n_bytes, n_tokens, over, fits] + ([kept] if keep else [])
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(cols, fields, strict=True)], schema=out)

    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(run, schema)


def op2_tokens(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return prefix_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
