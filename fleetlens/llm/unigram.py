"""A unigram vocabulary from a SentencePiece model file, and the rules that token counts and encoding share.

The file's pieces and scores are read as a unigram model: the segmentation with the highest sum of scores counts, whatever
the file was made for.  Of segmentations that tie at a character, the one with the longest last piece stays, which is the
first best path that the usual unigram encoders find from the left.  Sums are in double precision.

A text is normalised as the library does for this kind of model: a space in front, spaces as U+2581.  A character without a
piece costs the least score less 10 and becomes its UTF-8 bytes' pieces.  A null or empty text has no pieces.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

SPACE = "▁"
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, tuple[int, float]]
    #: id of the piece of each byte, or of the unknown piece.
    bytes: tuple[int, ...]
    #: The bytes that each id stands for.
    plain: tuple[bytes, ...]

    @property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    @property
    def unknown(self) -> float:
        return min((score for _, score in self.ids.values()), default=0.0) - UNKNOWN_PENALTY

    def keys_of(self):
        """A function that cuts a text where no piece reaches across: into words with the spaces before them, and at line
        feeds.  chunk_of() gives the normalised characters of a cut.  If some piece does reach across, a text is one cut.
        """
        if any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in self.ids):
            return lambda text: [normalised(text)]
        spaced = re.compile(f"{SPACE}+[^{SPACE}]*").findall

        def keys(text: str) -> list[str]:
            out = []
            for k, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if k and not line:
                    out.append("\n")
                elif "" in words or SPACE in line:
                    head, mark, rest = line.replace(" ", SPACE).partition(SPACE)
                    out.append("\n" + head if k else SPACE + head)
                    out += spaced(mark + rest)
                else:
                    if k:
                        words[0] = "\n" + words[0]
                    out += words
            if out[0][:1] == SPACE and len(out) > 1 and text[:1] in (" ", SPACE):
                out[:2] = [out[0] + out[1]]  # the space in front joins those of the text
            return out

        return keys


def chunk_of(key: str) -> str:
    return key if key[:1] in ("\n", SPACE) else SPACE + key


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file.  It is read on the driver; tasks get it as a broadcast of bounded size."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, plain, of_byte = {}, [], {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            of_byte[int(piece[3:5], 16)] = i
            plain.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            plain.append(b"")
        else:
            ids[piece] = (i, model.get_score(i))
            plain.append(piece.replace(SPACE, " ").encode())
    return Vocabulary(ids, tuple(of_byte.get(b, model.unk_id()) for b in range(256)), tuple(plain))


def normalised(text: str) -> str:
    return SPACE + text.replace(" ", SPACE)
