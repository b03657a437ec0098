"""Token ids of whole texts by the tokenizers library, with a memo.

Both vocabularies cut a text into pieces before they merge bytes, so a text's
ids are those of its pieces put together. Pieces of printable ASCII and Latin-1
letters are cut here by the vocabulary's own pattern and given to the library's
model; a run without white space that holds anything else goes to the library
whole. Each distinct piece is encoded once per worker, and the ids of each run
between blanks, its pieces put together, are kept as well; both memos are
bounded, and a caller whose workers hold other things can bound them further. Strings of special tokens in a text are ordinary text."""

from __future__ import annotations

import os
import re
import sys
from array import array

from feedrec.llm.common import kept

PIECES, RUNS = 1_000_000, 1_300_000  # entries of the memos
#: Unicode white space as the vocabularies' patterns take it (fixed values).
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_MARKS = "[!-/:-@\\[-`{-~]+"
_LATIN = "À-ÖØ-öø-ÿ"
#: Lower-casing vocabulary, white space dropped; the contractions are fixed values.
BLANK_DROPPED = re.compile(f"[!-~{_LATIN}]*[^ \\n!-~{_LATIN}][^ \\n]*|'(?:[sStTmMdD]|[rRvV][eE]|[lL][lL])|[A-Za-z{_LATIN}]+|[0-9]|{_MARKS}")
#: Byte-level vocabulary: one blank goes with the piece after it.
BYTE_LEVEL = re.compile(f" ?[!-~{_LATIN}]*[^!-~{_LATIN}{_WS}][^{_WS}]*|'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{_LATIN}]+| ?[0-9]+| ?{_MARKS}"
                        f"|[{_WS}]+(?![^{_WS}])|[{_WS}]")
INNER_BLANK = re.compile(f"[{_WS}] ")
PLAIN = re.compile(f" ?[!-~{_LATIN}]+")


def _packed(ids: list[int]) -> bytes:
    a = array("I", ids)  # four bytes an id
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, with ``end_id`` appended. A memo
    holds at most about ``most`` entries."""

    most = max(PIECES, RUNS)

    def __init__(self, path: str, pieces: re.Pattern, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.model, self.lower = self.tok.model, pieces.pattern == BLANK_DROPPED.pattern
        self.pieces, self.memo, self.runs = pieces, {}, {}
        # how the byte-level models write a blank and the letters beyond ASCII, asked of the library
        shown = (lambda c: self.tok.pre_tokenizer.pre_tokenize_str(c)[0][0])
        self.shown = str.maketrans({c: shown(c) for c in map(chr, range(0xC0, 0x100)) if c not in "×÷"})
        self.blank = " " if self.lower else shown(" ")
        self.end = _packed([end_id])

    def _plain(self, p: str) -> bytes:
        """The ids of a piece of printable ASCII and Latin-1 letters."""
        q = p.lower() if self.lower else p
        if q[0] == " ":
            q = self.blank + q[1:]
        if not p.isascii():
            q = q.translate(self.shown)
        return _packed([t.id for t in self.model.tokenize(q)])

    def _learn(self, pieces: list[str]) -> None:
        memo = self.memo
        if len(memo) > min(PIECES, self.most):
            memo.clear()
        rest = []
        for p in {p for p in pieces if p not in memo}:
            if p.isascii() and p.isprintable() and p[-1] != " " or PLAIN.fullmatch(p):
                memo[p] = self._plain(p)
            else:
                rest.append(p)
        for p, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False) if rest else ()):
            memo[p] = _packed(e.ids)

    def _of(self, text: str) -> bytes:
        pieces = self.pieces.findall(text)
        try:
            return b"".join(map(self.memo.__getitem__, pieces))
        except KeyError:
            self._learn(pieces)
            return b"".join(map(self.memo.__getitem__, pieces))

    def _new_runs(self, runs: list[str], lead: str) -> None:
        known, memo = self.runs, self.memo
        if len(known) > min(RUNS, self.most):
            known.clear()
        if len(memo) > min(PIECES, self.most):
            memo.clear()
        for r in {r for r in runs if r not in known}:
            if r.isascii() and r.isalpha():  # one piece
                p = lead + r
                ids = memo.get(p)
                if ids is None:
                    ids = memo[p] = self._plain(p)
                known[r] = ids
            else:
                known[r] = self._of(lead + r)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if self.lower:  # blanks and line ends are dropped wherever they are
            if text.isascii():  # the library lower-cases these letters alike
                text = text.lower()
            head, lead, runs = b"", "", text.replace("\n", " ").split(" ")
        elif INNER_BLANK.search(text):  # runs of white space are pieces of their own
            return self._of(text) + self.end
        else:  # every blank goes with what follows it
            first, *runs = text.split(" ")
            head, lead = self._of(first), " "
        try:
            return head + b"".join(map(self.runs.__getitem__, runs)) + self.end
        except KeyError:
            self._new_runs(runs, lead)
            return head + b"".join(map(self.runs.__getitem__, runs)) + self.end


_encoders: dict[tuple, Encoder] = {}
kept.append(_encoders)


def encoder(path: str, pieces: re.Pattern, end_id: int, most: int = Encoder.most) -> Encoder:
    """One encoder per worker process and vocabulary; the last caller bounds its memos."""
    key = (path, pieces.pattern, end_id)
    if key not in _encoders:
        _encoders[key] = Encoder(path, pieces, end_id)
    _encoders[key].most = most
    return _encoders[key]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
