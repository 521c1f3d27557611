"""Splitting texts into the words that byte-level tokenizers encode one by one."""

from __future__ import annotations

import json
import re

from tokenizers import Tokenizer

#: Characters whose classes are the same in every Unicode version in use, without numbers other
#: than 0-9. Texts with any other character are split by the tokenizer itself, with the same result.
COMMON = re.compile("[\t-\r\x20-\x7e\x85\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-⁞]*")
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
#: Lower-casing turns some of these into letters beyond, so words have those as well.
LETTER += "".join(sorted({low for code in range(0x250) if len(low := chr(code).lower()) == 1 and ord(low) > 0x24F}))
WORDS = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\\s0-9{LETTER}]+"
PIECES = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\\s0-9{LETTER}]+|\\s+(?!\\S)|\\s+")
#: Words a worker remembers; longer ones than LONG are not remembered.
REMEMBERED, LONG = 250_000, 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next free code."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, free = {code: chr(code) for code in printing}, 0x100
    for code in range(256):
        if code not in letters:
            letters[code], free = chr(free), free + 1
    return [letters[code] for code in range(256)]


class Splitter:
    """Texts as pieces between added tokens, and pieces as words."""

    def __init__(self, path: str, pattern: str, lower: bool):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.settings = json.load(file)
        added = self.settings["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens must be plain")
        self.added = {token["content"]: token["id"] for token in added}
        choices = "|".join(re.escape(text) for text in sorted(self.added, key=len, reverse=True))
        self.between = re.compile(f"({choices})") if choices else None
        self.find, self.lower = re.compile(pattern).findall, lower

    def pieces(self, text: str) -> list[str]:
        """Odd places hold added tokens."""
        return self.between.split(text) if self.between and "<" in text else [text]

    def words(self, piece: str) -> list[str] | None:
        """The words of a piece, or None if the tokenizer's own splitter has to be asked."""
        if COMMON.fullmatch(piece):
            return self.find(piece.lower() if self.lower else piece)
        return None

    def asked(self, piece: str) -> list[str]:
        """The words by the tokenizer's own steps, spelled in byte letters."""
        if self.tokenizer.normalizer is not None:
            piece = self.tokenizer.normalizer.normalize_str(piece)
        return [word for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)]
