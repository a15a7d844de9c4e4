"""Public vocabularies seen as byte strings, and the byte pairs at which a text may be cut for certain.

A byte-pair encoder joins neighbours only into tokens of its vocabulary. Where two
neighbouring bytes stand inside no token at all, no merge ever crosses them: the
tokens left and right of such a pair do not depend on each other. ``Cutter`` finds
these places in a text; fragments between them are encoded apart and the ids joined.

The byte-level vocabulary splits a text by a pattern before it merges. A cut is kept
only where that pattern cannot tell the fragments from the whole text:

* its one look-ahead asks whether white space goes on, so no cut between white space
  and something else;
* an apostrophe may open a contraction if it comes first, so no cut before one;
* everywhere else the pattern takes runs of one class of characters, and a run that
  is cut gives the same tokens, as no merge crosses the cut.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np

# Unicode white space beyond ASCII, in UTF-8 (fixed values).
WIDE_SPACES = tuple(chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
LIKE_SPACE = ASCII_SPACE.copy()
LIKE_SPACE[28:32] = True  # separators that some engines count as white space
SPACE_ENDS = np.zeros(256, bool)
SPACE_ENDS[[s[-1] for s in WIDE_SPACES]] = True
BLOCK = 1 << 20  # bytes of a text cut and encoded at a time
CACHED_BYTES = 64  # longer fragments are rare and not kept
CACHE_SIZE = 150_000
SHORT_BYTES = 1024  # fragments that the rank file's encoder gets; long white space would overflow its stack
SPACE_MARK = "▁"


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself, the others as the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def place(name: str, folder: str | None) -> str:
    import public_tokenizers as P

    return os.path.join(folder, name) if folder else P.path(name)


def pairs_inside(tokens) -> np.ndarray:
    """256 x 256 flags: whether byte x is followed by byte y inside some token."""
    inside = np.zeros((256, 256), bool)
    for t in tokens:
        b = np.frombuffer(t, np.uint8)
        inside[b[:-1], b[1:]] = True
    return inside


class ByteLevel:
    """A byte-level BPE vocabulary of the tokenizers library; ``plain`` reads special tokens in a text as ordinary text."""

    def __init__(self, folder: str | None = None, name: str = "byte_bpe_50k", plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import base64

        import public_tokenizers as P
        import tiktoken
        from tokenizers import Tokenizer

        with open(place(f"{name}.tiktoken", folder), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.short = tiktoken.Encoding(name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})

        self.tokenizer = Tokenizer.from_file(place(f"{name}.json", folder))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True  # special strings are found here, before a text is cut
        alphabet, vocabulary = byte_alphabet(), self.tokenizer.get_vocab(with_added_tokens=True)
        added = {} if plain else self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content.encode(): i for i, t in added.items()}
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.tokens[i] = bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.cutter = Cutter(pairs_inside(self.tokens), pattern=True)
        self._known = Known(self._encode)

    def packed(self, fragments: list[bytes]) -> list[bytes]:
        """Little-endian uint32 ids of each fragment; a fragment seen before is looked up."""
        return self._known.of(fragments)

    def _encode(self, new: list[bytes]) -> list[bytes]:
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in self.ids_of(new)]

    def ids_of(self, fragments: list[bytes]) -> list[list[int]]:
        return list(map(self._ids, fragments))

    def _ids(self, fragment: bytes) -> list[int]:
        """Both encoders hold the same vocabulary; the rank file's is several times as fast on a short fragment."""
        if len(fragment) <= SHORT_BYTES:
            return self.short.encode_ordinary(fragment.decode())
        return self.tokenizer.encode(fragment.decode(), add_special_tokens=False).ids

    def encoded(self, text: bytes) -> Iterator[bytes]:
        """Packed ids of a text, block by block."""
        for part, special in self._split(text):
            if special is not None:
                yield np.array([special], "<u4").tobytes()
            else:
                for fragments in self.cutter.blocks(part):
                    yield b"".join(self.packed(fragments))

    def _split(self, text: bytes) -> Iterator[tuple[bytes, int | None]]:
        at = 0
        while self.special:
            hits = [(k, -len(s), s) for s in self.special if (k := text.find(s, at)) >= 0]
            if not hits:
                break
            k, _, s = min(hits)
            yield text[at:k], None
            yield s, self.special[s]
            at = k + len(s)
        yield text[at:] if at else text, None


class Pieces:
    """A sentencepiece BPE model; ids of fragments as they stand inside a text, without the space it puts before one."""

    def __init__(self, folder: str | None = None, name: str = "piece_bpe_32k.model"):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=place(name, folder))
        self.tokens = [self._bytes(i) for i in range(self.model.get_piece_size())]
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.cutter = Cutter(pairs_inside(self.tokens), pattern=False)
        # A line feed is a byte of its own in this vocabulary: behind it nothing joins the space put in front.
        self.lead = self.model.encode("\n", num_threads=1)
        if pairs_inside(self.tokens)[:, 10].any() or pairs_inside(self.tokens)[10].any():
            raise ValueError("the piece vocabulary joins line feeds to other bytes")
        self._known = Known(self._encode)

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        return piece.replace(SPACE_MARK, " ").encode()

    def packed(self, fragments: list[bytes]) -> list[bytes]:
        return self._known.of(fragments)

    def _encode(self, new: list[bytes]) -> list[bytes]:
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in self.ids_of(new)]

    def ids_of(self, fragments: list[bytes]) -> list[list[int]]:
        """Ids of each fragment. Those without a line feed are encoded as lines of one text, as nothing joins over it."""
        lines = [f for f in fragments if b"\n" not in f]
        ids, end = self.model.encode("\n" + b"\n".join(lines).decode(), num_threads=1), self.lead[-1]
        found = {}
        if lines:
            array = np.array(ids)
            edges = [*(np.flatnonzero(array == end) + 1).tolist(), len(ids) + 1]
            found = {f: ids[x : y - 1] for f, x, y in zip(lines, edges, edges[1:])}
        n = len(self.lead)
        return [found[f] if f in found else self.model.encode("\n" + f.decode(), num_threads=1)[n:] for f in fragments]


class Known:
    """What was made of short fragments lately: two generations of ``CACHE_SIZE``, of which the older one is dropped.

    A fragment in use moves to the younger one, so frequent words stay however many rare ones pass by.
    """

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def of(self, fragments: list[bytes]) -> list:
        """``make`` of each fragment, called once for all that are not known."""
        out = list(map(self.young.get, fragments))
        if None in out:
            missing = [i for i, x in enumerate(out) if x is None]
            found = {fragments[i]: self.old.get(fragments[i]) for i in missing}
            new = [f for f, x in found.items() if x is None]
            if new:
                found.update(zip(new, self.make(new)))
            for i in missing:
                out[i] = found[fragments[i]]
            if len(self.young) > CACHE_SIZE:
                self.young, self.old = {}, self.young
            self.young.update((f, x) for f, x in found.items() if len(f) <= CACHED_BYTES)
        return out


class Cutter:
    """Certain cuts for one vocabulary, or for several at once by ``both``."""

    def __init__(self, inside: np.ndarray, pattern: bool):
        self.inside, self.pattern = inside, pattern
        cut = ~inside
        cut[:, 0x80:0xC0] = False  # inside a character
        if pattern:
            cut[:, ord("'")] = False
            cut[np.ix_(LIKE_SPACE, ~ASCII_SPACE)] = False
        self.table = cut.ravel()

    def both(self, other: Cutter) -> Cutter:
        """Cuts that are certain for either vocabulary."""
        return Cutter(self.inside | other.inside, self.pattern or other.pattern)

    def cuts(self, body: np.ndarray) -> np.ndarray:
        """Positions in a byte array before which it may be cut."""
        at = np.flatnonzero(self.table[body[:-1].astype(np.uint16) * 256 + body[1:]]) + 1
        if self.pattern and len(at):
            risky = SPACE_ENDS[body[at - 1]] & ~ASCII_SPACE[body[at]]
            if risky.any():
                drop = [k for k in np.flatnonzero(risky) if bytes(body[max(0, at[k] - 3) : at[k]]).endswith(WIDE_SPACES)]
                at = np.delete(at, drop)
        return at

    def blocks(self, text: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
        """The fragments of a text, about ``size`` bytes at a time; a stretch without a cut stays whole."""
        at = 0
        while at < len(text):
            end = at + size
            while True:
                body = np.frombuffer(text, np.uint8, count=min(end, len(text)) - at, offset=at)
                cuts = self.cuts(body)
                if end >= len(text):
                    edges = [0, *cuts.tolist(), len(body)]
                    break
                if len(cuts):
                    edges = [0, *cuts.tolist()]
                    break
                end = at + 2 * (end - at)
            yield [text[at + a : at + b] for a, b in zip(edges, edges[1:])]
            at += edges[-1]

    def next_cut(self, text: bytes, start: int, step: int = 4096) -> int:
        """The first certain cut at or after ``start``, else the end of the text."""
        at = max(start, 1)
        while at < len(text):
            body = np.frombuffer(text, np.uint8, count=min(at + step, len(text)) - max(0, at - 3), offset=max(0, at - 3))
            cuts = self.cuts(body) + max(0, at - 3)
            cuts = cuts[cuts >= at]
            if len(cuts):
                return int(cuts[0])
            at, step = min(at + step, len(text)), 2 * step
        return len(text)
