"""A SentencePiece vocabulary file as plain tables, and the cuts no piece crosses.

The file's path is a parameter; it is read once on the driver and travels to the
tasks as a broadcast of well under a megabyte.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

SPACE = "▁"  # how pieces write a space


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _pre_token_patterns(pairs: frozenset[str]) -> tuple[re.Pattern, re.Pattern]:
    """Pre-tokens: runs of letters and runs of other characters, each with the spaces
    before them. Letters that some piece joins with other characters count as others.
    Also the runs of letters alone."""
    odd: set[str] = set()
    while True:
        def letter(c: str) -> bool:
            return c.isalpha() and c not in odd
        more = {c for p in pairs if letter(p[0]) != letter(p[1]) and SPACE not in p for c in p if letter(c)}
        if not more:
            break
        odd |= more
    kept_out = "".join(map(re.escape, sorted(odd)))
    letters = rf"[^\W\d_{kept_out}]+"
    return re.compile(rf" *{letters}| *(?:[^\w \n{SPACE}]|[\d_{kept_out}])+| +|[\n{SPACE}]"), re.compile(letters)


@dataclass
class Vocabulary:
    """Ordinary pieces with their rank by score (0 is the best; equal scores share
    one), byte pieces by byte."""

    ids: dict[str, int]
    rank: dict[str, int]
    byte_ids: list[int]
    raw: list[bytes]                       # id -> the bytes it decodes to
    pairs: frozenset[str] = field(repr=False)  # neighbours inside some piece
    words: re.Pattern
    letters: re.Pattern
    key: str

    @classmethod
    def load(cls, path: str | None = None) -> "Vocabulary":
        import sentencepiece

        path = path or default_path()
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, byte_ids, raw = {}, [0] * 256, []
        for i in range(m.vocab_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                raw.append(b"")
            else:
                ids[piece] = i
                raw.append(piece.replace(SPACE, " ").encode())
        scores = sorted({m.get_score(i) for i in ids.values()}, reverse=True)
        place = {x: r for r, x in enumerate(scores)}
        pairs = frozenset(p[k:k + 2] for p in ids for k in range(len(p) - 1))
        return cls(ids, {p: place[m.get_score(i)] for p, i in ids.items()}, byte_ids, raw, pairs,
                   *_pre_token_patterns(pairs), f"{path}:{len(raw)}")

    def pre_tokens(self, text: str) -> list[str]:
        """The text with its leading dummy space, cut where no piece crosses: before a
        run of spaces, around line feeds and literal space marks, and between a run of
        letters and what is none. Joined they give it back; an empty text has none."""
        return self.words.findall(" " + text) if text else []

    def parts(self, token: str) -> list[str]:
        """A pre-token as pieces write it, cut further where no piece crosses (runs of
        letters stay whole); nothing for a literal space mark, which is its bytes."""
        if token == SPACE:
            return []
        token = token.replace(" ", SPACE)
        return [token] if token[-1].isalpha() else self.cut(token)

    def fallback(self, char: str) -> list[int]:
        """The byte pieces of a character (or of a literal space mark)."""
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    def cut(self, token: str) -> list[str]:
        """Parts of a pre-token that no piece can span: neighbours that stand
        together in no piece are never joined, so each part is segmented alone."""
        pairs, out, at = self.pairs, [], 0
        for k in range(1, len(token)):
            if token[k - 1:k + 1] not in pairs:
                out.append(token[at:k])
                at = k
        out.append(token[at:])
        return out
