"""Byte-pair encoding and decoding by depth-first traversal of a trie of distinct words.

The encoding of a word is fixed by its *last token*: the one vocabulary token ``t`` ending the
word that can stand after the last token of what precedes it.  So the state of a trie node is
one token, a child's state follows from the states on its path, and words that share a prefix
share its states.  Visiting distinct words in byte order walks their trie depth first; the
stack then holds the states of the current path, and only the nodes below the common prefix
with the word before are computed.

Whether token ``b`` can stand after token ``a`` is decided from the merge ranks: undo merges at
the seam, latest first, and see whether a merge across the seam would have come earlier.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterable
from itertools import islice
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, map_batches, text_of

NEVER = 1 << 60
#: Entries a worker keeps of encoded words and of judged token pairs before it starts anew.
WORDS_KEPT, PAIRS_KEPT = 400_000, 400_000
#: A text of more code points is cut into words lazily, this many words at a time.
LONG_TEXT, WORDS_AT_A_TIME = 2_000_000, 200_000
#: Fixed value: how byte-level vocabularies split text before merging.  White space is spelled
#: out, as the Unicode White_Space property, since libraries differ on ``\s``.
SPACE = r"\x09-\x0d\x20\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TrieBpe:
    """Encoder and decoder of one byte-level BPE vocabulary."""

    def __init__(self, model: str):
        spec = json.loads(model)
        letters = byte_letters()
        spell = lambda s: bytes(letters[c] for c in s)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: spell(s) for s, i in vocab.items() if s not in self.special}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.joins: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # id: rank, left part, right part
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, ab = vocab[left], vocab[right], vocab[left + right]
            self.joins[a, b] = rank
            self.made.setdefault(ab, (rank, a, b))
        self.suffixes = {b[i:] for b in self.id_of for i in range(len(b))}
        self.whole: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )

    def follows(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay apart when their joint bytes are encoded."""
        made, joins = self.made, self.joins
        above_a = above_b = NEVER  # when the symbol at the seam is merged into a larger one
        while True:
            join = joins.get((a, b))
            if join is not None and join < above_a and join <= above_b:
                return False
            rank_a, rank_b = made.get(a, (-1,))[0], made.get(b, (-1,))[0]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                above_a, _, a = made[a]
            else:
                above_b, b, _ = made[b]

    def stands(self, token: int) -> bool:
        """Whether the bytes of a token encode to that token alone."""
        known = self.whole.get(token)
        if known is None:
            symbols = [self.id_of[bytes([x])] for x in self.bytes_of[token]]
            while len(symbols) > 1:
                ranks = [self.joins.get(p, NEVER) for p in zip(symbols, symbols[1:], strict=False)]
                at = min(range(len(ranks)), key=ranks.__getitem__)
                if ranks[at] == NEVER:
                    break
                joined = self.id_of[self.bytes_of[symbols[at]] + self.bytes_of[symbols[at + 1]]]
                symbols[at : at + 2] = [joined]
            known = self.whole[token] = symbols == [token]
        return known

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words, depth first over their trie."""
        id_of, suffixes, pairs, stands, follows = self.id_of, self.suffixes, self.pairs, self.stands, self.follows
        last: list[int] = [-1]  # the state of each prefix of the word at hand, by length
        size: list[int] = [0]
        before = b""
        for word, text in sorted((w.encode(), w) for w in words):
            n, shared = len(word), 0
            for shared in range(min(n, len(before)) + 1):  # noqa: B007
                if shared == n or shared == len(before) or word[shared] != before[shared]:
                    break
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, n + 1):
                for start in range(end - 1, -1, -1):
                    piece = word[start:end]
                    if piece not in suffixes:
                        raise ValueError(f"no token of the vocabulary ends at byte {end} of {text!r}")
                    token = id_of.get(piece)
                    if token is None or not stands(token):
                        continue
                    if not start:
                        break
                    key = last[start] << 32 | token
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = follows(last[start], token)
                    if fits:
                        break
                last.append(token)
                size.append(end - start)
            before, ids, at = word, [], n
            while at:
                ids.append(last[at])
                at -= size[at]
            self.words[text] = struct.pack(f"<{len(ids)}I", *reversed(ids))
        if len(pairs) > PAIRS_KEPT:
            pairs.clear()

    def pieces(self, text: str, plain: bool) -> Iterable[tuple[list[str], int | None]]:
        """Runs of words, each with the reserved id that follows it, if any; plain: never any."""
        special = not plain and self.split_special and any(s in text for s in self.special)
        parts = self.split_special.split(text) if special else [text]
        for i in range(0, len(parts), 2):
            part, reserved = parts[i], self.special[parts[i + 1]] if i + 1 < len(parts) else None
            if len(part) <= LONG_TEXT:
                yield WORD.findall(part), reserved
            else:
                found = (m[0] for m in WORD.finditer(part))
                while some := list(islice(found, WORDS_AT_A_TIME)):
                    yield some, None
                yield [], reserved

    def prepare(self, texts: Iterable[str], plain: bool = False) -> list[list[tuple[list[str], int | None]] | None]:
        """Words of each text that is not very long, all learned together so that more prefixes are shared."""
        cut = [None if len(t) > LONG_TEXT else list(self.pieces(t, plain)) for t in texts]
        seen = set().union(*(words for pieces in cut if pieces for words, _ in pieces))
        missing = seen.difference(self.words)
        if len(self.words) + len(missing) > WORDS_KEPT:
            self.words.clear()
            missing = seen
        self.learn(missing)
        return cut

    def join(self, pieces: list[tuple[list[str], int | None]]) -> bytes:
        """Ids of a text cut by ``prepare``."""
        look = self.words.__getitem__
        return b"".join(b"".join(map(look, words)) + (b"" if reserved is None else struct.pack("<I", reserved)) for words, reserved in pieces)

    def encode(self, text: str, plain: bool = False) -> Iterable[bytes]:
        """Ids of a text as runs of little-endian unsigned 32-bit integers.

        plain: the strings of special tokens in the text are ordinary text.
        """
        for words, reserved in self.pieces(text, plain):
            if missing := set(words).difference(self.words):
                if len(self.words) > WORDS_KEPT:
                    self.words.clear()
                    missing = set(words)
                self.learn(missing)
            yield b"".join(map(self.words.__getitem__, words)) + (b"" if reserved is None else struct.pack("<I", reserved))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of a run of ids; ids that the vocabulary doesn't have raise KeyError."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))


def load(model: str) -> TrieBpe:
    """The encoder of a vocabulary, one for each worker process while its tasks use it."""
    return kept(("bpe", hash(model)), lambda: TrieBpe(model))


def encode_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode each text; one row out for each row in, in one pass without a shuffle.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids as little-endian
    unsigned 32-bit integers and of the text that decoding the ids gives back.

    Null text: as empty (no ids).  Empty table: empty result.  Repeated rows and ids: a row each.
    Very long texts are encoded in runs of a bounded number of words.  Other columns are dropped,
    whatever their names.  The vocabulary (a fixed file of a few megabytes, read on the driver) is
    broadcast; a worker keeps at most ``WORDS_KEPT`` words encoded, until a task of another operator.
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def make():
        bpe = load(model.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            count, ids_hex, text_hex = [], [], []
            texts = batch.column(1).to_pylist()
            joined = [pieces and bpe.join(pieces) for pieces in bpe.prepare(texts)]
            for text, whole in zip(texts, joined, strict=True):
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                tail = b""
                for ids in bpe.encode(text) if whole is None else [whole]:
                    n += len(ids) // 4
                    of_ids.update(ids)
                    tail += bpe.decode(ids)
                    cut = len(tail) - next((k for k in (1, 2, 3) if len(tail) >= k and tail[-k] >= 0xC0), 0)
                    of_text.update(tail[:cut].decode("utf-8", "replace").encode())
                    tail = tail[cut:]
                of_text.update(tail.decode("utf-8", "replace").encode())
                count.append(n)
                ids_hex.append(of_ids.hexdigest())
                text_hex.append(of_text.hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    return map_batches(rows, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", keeps=True)
