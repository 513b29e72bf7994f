"""SentencePiece BPE encoding by backtracking, and decoding.

A sequence of pieces is what merging gives if each two neighbours are: joined and merged again,
they come out as the same two. So the encoder walks forward with the longest piece at each
place (found for all places at once by an Aho-Corasick pass over the reversed text), goes on if
the piece is compatible with its left neighbour, else tries the next shorter piece, else steps
back. A bit a position records where no way forward exists, so no position fails twice.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sheaf.llm.shared import arrow_rows, held

SPACE = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: Entries of the memos of a Python worker: words of a generation, and pairs.
MOST_WORDS, MOST_PAIRS = 150_000, 300_000


class Model:
    """The pieces of a merge-type SentencePiece model with byte fallback and an identity
    normaliser that adds a dummy prefix and keeps blanks; other models are refused."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(data)
        norm = m.normalizer_spec
        if m.trainer_spec.model_type != 2 or not m.trainer_spec.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only BPE models with byte fallback, identity normaliser, dummy prefix and kept blanks")
        self.text = [p.piece for p in m.pieces]
        self.size = [len(p) for p in self.text]
        self.score = [p.score for p in m.pieces]
        self.ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.runs = {len(p): i for p, i in self.ids.items() if set(p) == {SPACE}}
        own = {p: i for p, i in self.ids.items() if len(p) == 1 or set(p) != {SPACE}}
        least = min(self.score[i] for p, i in own.items() if p != SPACE)
        if any(SPACE in p[1:] for p in own) or any(self.score[i] >= least for n, i in self.runs.items() if n > 1) or len({self.score[i] for n, i in self.runs.items() if n > 1}) > 1:
            raise ValueError("pieces with inner spaces, or runs of spaces that merge early")
        self.alphabet = {c for p in own for c in p}
        if any(c not in own for c in self.alphabet):
            raise ValueError("a character of a piece is no piece")
        self.back = ahocorasick.Automaton()
        for p, i in own.items():
            self.back.add_word(p[::-1], i)
        self.back.make_automaton()
        self.own = own
        self.shorter = self._prefixes(own)
        self.pairs: dict[int, bool] = {}
        self.words = Words(self)
        self.blanks: dict[int, list[int]] = {}

    @staticmethod
    def _prefixes(own: dict[str, int]) -> dict[int, int]:
        """Each piece's longest proper prefix that is a piece."""
        out = {}
        for p, i in own.items():
            for n in range(len(p) - 1, 0, -1):
                if (j := own.get(p[:n])) is not None:
                    out[i] = j
                    break
        return out

    def merge(self, s: str) -> list[int]:
        """Plain merging, best score first, then leftmost. For short strings."""
        part, n = list(s), len(s)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (k := self.ids.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (-self.score[k], i, j, part[i] + part[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, whole = heapq.heappop(heap)
            if not part[i] or not part[j] or part[i] + part[j] != whole or right[i] != j:
                continue
            part[i], part[j] = whole, ""
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [self.ids[p] for p in part if p]

    def compatible(self, a: int, b: int) -> bool:
        got = self.pairs.get(a << 32 | b)
        if got is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            got = self.pairs[a << 32 | b] = self.merge(self.text[a] + self.text[b]) == [a, b]
        return got

    def backtrack(self, s: str) -> list[int]:
        """Pieces of a string over the alphabet, with a space at its start at most."""
        n = len(s)
        longest = [-1] * n
        for end, i in self.back.iter(s[::-1]):  # of those that end at one place, the longest comes first
            if longest[n - 1 - end] < 0:
                longest[n - 1 - end] = i
        size, pairs, shorter = self.size, self.pairs, self.shorter
        failed = bytearray()  # a bit for each position, made when first needed
        out: list[int] = []
        pos, piece, last = 0, longest[0], -1
        while pos < n:
            while True:
                end = pos + size[piece]
                if not failed or not failed[end >> 3] >> (end & 7) & 1:
                    fits = True if last < 0 else pairs.get(last << 32 | piece)
                    if fits is None:
                        fits = self.compatible(last, piece)
                    if fits:
                        out.append(piece)
                        pos, last = end, piece
                        piece = longest[pos] if pos < n else -1
                        break
                if (piece := shorter.get(piece, -1)) < 0:
                    failed = failed or bytearray(n // 8 + 1)
                    failed[pos >> 3] |= 1 << (pos & 7)
                    if last < 0:
                        raise ValueError("no segmentation")
                    piece = out.pop()
                    pos -= size[piece]
                    last = out[-1] if out else -1
                    break
        return out

    def spaces(self, n: int) -> list[int]:
        """Pieces of n spaces. All runs have one score, so the leftmost pair merges first."""
        if n not in self.blanks:
            if len(self.blanks) > 1000:
                self.blanks.clear()
            self.blanks[n] = self.merge(SPACE * n)
        return self.blanks[n]

    def word(self, s: str) -> list[int]:
        """Pieces of spaces followed by other characters (either may lack)."""
        body = s.lstrip(SPACE)
        n = len(s) - len(body)
        if not body:
            return self.spaces(n)
        text = (SPACE if n else "") + body
        out: list[int] = []
        if self.alphabet.issuperset(body):
            out = self.backtrack(text)
        else:
            start = 0
            for i in [i for i, c in enumerate(text) if c not in self.alphabet] + [len(text)]:
                if start < i:
                    out += self.backtrack(text[start:i])
                if i < len(text):
                    out += [self.byte[b] for b in text[i].encode()]
                start = i + 1
        if n and out[0] == self.ids[SPACE]:  # the last space did not merge with the word
            return self.spaces(n) + out[1:]
        return self.spaces(n - 1) + out if n > 1 else out

    def split(self, text: str) -> list[str]:
        """Parts that never merge with each other."""
        return PARTS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for w in self.split(text) for i in self.word(w)]

    def joined(self, ids: list[int]) -> str:
        """The pieces' text, byte pieces put together, blanks as in pieces."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.text[i] for i in ids])
        out = bytearray()
        for i in ids:
            out += bytes([self.byte_of[i]]) if i in self.byte_of else self.text[i].encode()
        return out.decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the dummy prefix."""
        s = self.joined(ids).replace(SPACE, " ")
        return s[1:] if ids and self.text[ids[0]].startswith(SPACE) else s


PARTS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


class Words(dict):
    """Memo of parts: ids as text, their number, the pieces' text. A full generation becomes
    the old one, from which words in use come back."""

    def __init__(self, model: Model):
        self.model = model
        self.old: dict = {}

    def __missing__(self, w: str) -> tuple[str, int, str]:
        if (got := self.old.get(w)) is not None:
            self[w] = got
            return got
        ids = self.model.word(w)
        text = self.model.joined(ids)
        got = (",".join(map(str, ids)), len(ids), w if text == w else text)  # an equal text takes no room of its own
        if len(self) >= MOST_WORDS:
            self.old = dict(self)
            self.clear()
        if len(w) < 200:
            self[w] = got
        return got


def model_of(data: bytes) -> Model:
    """One model a Python process."""
    return held("pieces " + hashlib.sha256(data).hexdigest(), lambda: Model(data))


def encoded(docs: DataFrame, model_file: str, ids: bool = False, text: bool = True) -> DataFrame:
    """Rows of ``docs`` with n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the text decoded from those ids); with ``ids``, also the ids themselves,
    and without ``text``, the text stays behind in the Python worker.

    A null text counts as empty and has no ids. Texts are encoded whole, however long, and where
    several merges of one score are open the leftmost is made, as in the library. Rows are
    independent: repeated ones give repeated results, an empty table none, and other columns pass
    through, but for those that share a new name.
    The model file (half a MB) is read on the driver and broadcast.
    """
    with open(model_file, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())
    new = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()} | ({"ids": pa.list_(pa.int32())} if ids else {})
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(data.value)
        for batch in batches:
            n, h, d, lists = [], [], [], []
            for t in batch.column("text").to_pylist():
                got = [m.words[w] for w in m.split(t or "")]
                joined = ",".join([x[0] for x in got])
                n.append(sum([x[1] for x in got]))
                h.append(hashlib.sha256(joined.encode()).hexdigest())
                d.append(hashlib.sha256("".join([x[2] for x in got])[1:].replace(SPACE, " ").encode()).hexdigest())
                if ids:
                    lists.append([int(i) for i in joined.split(",")] if joined else [])
            arrays = [pa.array(x, t) for x, t in zip([n, h, d] + [lists] * ids, new.values())]
            kept = [c for c in batch.schema.names if text or c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *arrays], [*kept, *new])

    kinds = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "ids": "array<int>"}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if text or f.name != "text"] + [f"{c} {kinds[c]}" for c in new])
    return arrow_rows(docs, run, schema)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), text=False)
