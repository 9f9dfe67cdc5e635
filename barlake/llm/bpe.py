"""Byte-level BPE through the ``tokenizers`` library, one library call per
distinct piece of text.

Where non-white space is followed by white space the byte-level
pre-tokenizer always cuts, whatever stands around, so a text may be cut there
and the ids of its pieces joined.  Pieces repeat far more often than texts;
each Python worker keeps the ids of those it has met, up to ``CACHE_PIECES``,
and starts afresh beyond that.

A single piece is costly in ``tokenizers``, which tracks offsets.  Where the
vocabulary file's merges are in id order, ``tiktoken`` does the same merges
from the same file several times faster, so plain pieces go there.  Beyond
ASCII the two could still differ in the class they give a character: each such
character is put through both among letters, digits, marks and white space
when a worker first meets it, and pieces that hold one with different ids,
or a special string, always go to ``tokenizers``.  Which library a piece goes
to depends on its characters alone, never on the worker or the order of texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array

#: Pieces one worker remembers (about 200 bytes each).
CACHE_PIECES = 800_000
#: Surroundings in which both libraries must agree on a character.
PROBES = ("{c}", "a{c}", "{c}a", "1{c}", "{c}1", "!{c}", "{c}!", " {c}", "{c} ", "a{c}a", "1{c}1", "!{c}!", " {c}{c} a", "{c}{c}{c}", "'{c}s", "a {c}1!{c}  {c}a")
#: Texts whose new pieces go to the library together.
GROUP = 256

# The characters with Unicode's White_Space property.
WHITE = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# Fixed value: the byte-level pre-tokenizer's pattern.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ENCODERS: dict = {}


def default_tokenizer() -> str:
    """Place of the public byte-level BPE vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the file: itself
    if printable, else the next free one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _fast(path: str):
    """tiktoken over the same vocabulary, or None where that is not sure to
    merge alike."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space"):
        return None
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if model.get("type") != "BPE" or model.get("ignore_merges") or model.get("dropout") or ids != sorted(set(ids)):
        return None
    of = _byte_alphabet()
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(of[c] for c in w): i for w, i in vocab.items() if w not in special}
    if len(ranks) != len(merges) + 256:
        return None
    return tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class PieceEncoder:
    """Ids of whole texts as the library gives them, as little-endian uint32
    bytes, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.no_truncation()
        self._tok.no_padding()
        self._special = re.compile("|".join(re.escape(t.content) for t in self._tok.get_added_tokens_decoder().values()) or r"(?!)")
        self._quick = _fast(path)
        self._same: set = set()    # characters beyond ASCII on which both agree
        self._differ: set = set()  # and the others
        self._spaced: dict = {}   # piece after a space; None: it ends in white space
        self._bare: dict = {}     # piece as it stands

    def _slow(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _probe(self, chars: set) -> None:
        """Sort characters not met before into those both libraries treat alike
        and the rest."""
        new = sorted(c for c in chars - self._same - self._differ if c > "\x7f")
        probes = [p.format(c=c) for c in new for p in PROBES]
        alike = [a == array("I", self._quick(t)).tobytes() for t, a in zip(probes, self._slow(probes))] if new else []
        for i, c in enumerate(new):
            (self._same if all(alike[i * len(PROBES):(i + 1) * len(PROBES)]) else self._differ).add(c)

    def _library(self, texts: list[str]) -> list[bytes]:
        if self._quick is None:
            return self._slow(texts)
        self._probe({c for t in texts if not t.isascii() for c in t})
        quick, special, differ = self._quick, self._special.search, self._differ
        out = [None if special(t) or differ and not differ.isdisjoint(t) else array("I", quick(t)).tobytes() for t in texts]
        left = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(left, self._slow([texts[i] for i in left])):
            out[i] = x
        return out

    def _fill_spaced(self, pieces: set) -> None:
        if len(self._spaced) > CACHE_PIECES:
            self._spaced.clear()
        new = [p for p in pieces if p not in self._spaced]
        good = [p for p in new if p and not p[-1].isspace()]
        self._spaced.update(dict.fromkeys(new))
        self._spaced.update(zip(good, self._library([" " + p for p in good])))

    def _whole(self, pieces: list[str]) -> bytes:
        if len(self._bare) > CACHE_PIECES // 8:
            self._bare.clear()
        new = list({p for p in pieces if p not in self._bare})
        if new:
            self._bare.update(zip(new, self._library(new)))
        return b"".join(map(self._bare.__getitem__, pieces))

    def encode(self, texts: list[str]):
        """Yield the id bytes of each text, in order."""
        for at in range(0, len(texts), GROUP):
            cut = [t.split(" ") for t in texts[at:at + GROUP]]
            inner: set = set()
            for p in cut:
                inner.update(p[1:-1])
            self._fill_spaced(inner)
            get = self._spaced.__getitem__
            for p, text in zip(cut, texts[at:at + GROUP]):
                if len(p) == 1:
                    yield self._whole(_UNIT.findall(text))
                    continue
                head = p[0]
                try:
                    if head and head[-1].isspace():
                        raise TypeError
                    body = b"".join(map(get, p[1:-1]))
                except TypeError:  # white space of several characters: cut by units
                    yield self._whole(_UNIT.findall(text))
                    continue
                yield self._whole([head]) + body + self._whole([" " + p[-1]])


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for the vocabulary file at ``path``."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
