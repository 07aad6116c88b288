"""Fast exact encoding of whole texts with a public tokenizer.

Texts are cut where the tokenizer's own pre-tokeniser always cuts, and the ids
of each distinct chunk are kept, so a chunk is encoded once per worker rather
than once per occurrence.  Texts that cannot be cut safely, and all texts of a
tokenizer of another make, go to the tokenizer whole.  The result equals ``Tokenizer.encode(text, add_special_tokens=False)``,
with ``encode_special_tokens`` set unless ``special`` is asked for.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np

from loamframe.llm.shared import CACHES

#: Chunks seen twice and chunks seen once that one worker remembers; each memory is emptied when full.
HOT_CHUNKS, COLD_CHUNKS = 400_000, 250_000
#: Characters cut at once.
SEGMENT = 1 << 20

#: The two makes of tokenizers that texts are cut for (fixed values of their files).
BYTE_LEVEL = {
    "normalizer": None,
    "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
    "end_of_word_suffix": None,
}
WORD_LEVEL = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "end_of_word_suffix": "</w>",
}

_UNSAFE = re.compile(r"\s\s|\s\Z|\r")
_LATIN = re.compile(r"[^\x00-ɏ]")


def byte_level_keys(text: str) -> list[str] | None:
    """Chunks of a text for a byte-level tokenizer whose words carry the space before them.

    A key stands for itself with a space before it, or, when it begins with a
    line feed, for itself, or after a leading carriage return for the rest.
    None where white space repeats or ends the text: there cuts are unsafe.
    """
    if _UNSAFE.search(text):
        return None
    keys = text.replace("\n", " \n").split(" ")
    keys[0] = "\r" + keys[0]
    return keys


def byte_level_chunk(key: str) -> str:
    if key[:1] == "\r":
        return key[1:]
    return key if key[:1] == "\n" else " " + key


def word_keys(text: str) -> list[str]:
    """Chunks for a tokenizer that lower-cases and drops white space."""
    if not _LATIN.search(text):
        text = text.lower()
    return text.replace("\n", " ").split(" ")


def word_chunk(key: str) -> str:
    return key


def make_of(path: str) -> str | None:
    """``byte`` or ``word`` for tokenizers of the two makes, else None."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    model = config["model"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")) and config["post_processor"] is None
    own = {"normalizer": config["normalizer"], "pre_tokenizer": config["pre_tokenizer"], "end_of_word_suffix": model.get("end_of_word_suffix")}
    return {True: "byte" if own == BYTE_LEVEL else "word" if own == WORD_LEVEL else None, False: None}[plain]


#: The printable character that byte-level vocabularies write for each byte.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_MARKS = frozenset(".,!?;:)\"-")


def _printed(word: str) -> str:
    return word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)


def segments(text: str) -> Iterator[str]:
    """Pieces of a long text, each but the first starting with a space."""
    at = 0
    while len(text) - at > SEGMENT:
        end = text.find(" ", at + SEGMENT)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


class ChunkEncoder:
    """Encodes lists of texts to little-endian id bytes of type ``dtype``.

    With ``special``, the strings of special tokens in a text give their ids, as
    the tokenizer does if nothing is set; else they are ordinary text.
    """

    def __init__(self, path: str, special: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # texts with one of these go whole to a tokenizer that nothing is set on; it may look for them in normalised text
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.added = re.compile("|".join(added), re.IGNORECASE) if added else None
        self.path, self.plain = path, None
        make = make_of(path)
        word = make == "word"
        self.cuts = make is not None
        self.keys: Callable[[str], list[str] | None] = (word_keys if word else byte_level_keys) if self.cuts else lambda text: None
        self.chunk = word_chunk if word else byte_level_chunk
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.word = word
        self.bare = Tokenizer(self.tokenizer.model)  # for words that are already split and printed
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.marks = {m: self._whole(m) for m in _MARKS}
        self.line = b"" if word else self._whole("\n")
        self.hot: dict[str, bytes] = {}
        self.cold: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        tokenizer = self.tokenizer
        if self._has_added(text):
            if self.plain is None:
                self.plain = type(tokenizer).from_file(self.path)
            tokenizer = self.plain
        return array(self.code, tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _has_added(self, text: str) -> bool:
        return self.added is not None and self.added.search(text) is not None

    def _letters(self, body: str) -> bool:
        """Whether the tokenizer takes ``body`` as one word just as it stands."""
        return body.isalpha() and (not self.word or (not _LATIN.search(body) and body == body.lower()))

    def _encode_new(self, keys: list[str]) -> dict[str, bytes]:
        """Ids of chunks.

        Letters, perhaps with one mark after them, go to the model alone as the
        words they are; other chunks go to the whole tokenizer.
        """
        code, marks, letters = self.code, self.marks, self._letters
        simple, odd, built = [], [], []
        for k in keys:
            if letters(k):
                simple.append(k)
                continue
            after = marks.get(k[-1:])
            body = k if after is None else k[:-1]
            before = b""
            if body[:1] == "\n" and not self.word:
                before, body = self.line, "\r" + body[1:]
            if letters(body[1:] if body[:1] == "\r" and not self.word else body):
                built.append((k, before, body, after or b""))
            else:
                odd.append(k)
        hot, cold, own = self.hot, self.cold, set(simple)
        words = simple + list({b for _, _, b, _ in built if b not in hot and b not in cold and b not in own})
        space = "" if self.word else _BYTES[32]
        printed = [_printed(w[1:]) if w[0] == "\r" else space + _printed(w) for w in words]
        out = {w: array(code, e.ids).tobytes() for w, e in zip(words, self.bare.encode_batch_fast(printed, add_special_tokens=False), strict=True)}
        for k, e in zip(odd, self.tokenizer.encode_batch_fast([self.chunk(k) for k in odd], add_special_tokens=False), strict=True):
            out[k] = array(code, e.ids).tobytes()
        for k, before, body, after in built:
            ids = out.get(body) or hot.get(body) or cold[body]
            out[k] = before + ids + after
        return out

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of chunks that are not hot; those seen before become so."""
        cold, again, new = self.cold, {}, []
        for k in missing:
            ids = cold.pop(k, None)
            if ids is None:
                new.append(k)
            else:
                again[k] = ids
        fresh = self._encode_new(new)
        if len(self.hot) + len(again) > HOT_CHUNKS:
            self.hot = {}
        if len(cold) + len(fresh) > COLD_CHUNKS:
            self.cold = {}
        self.hot.update(again)
        self.cold.update(fresh)
        return again | fresh

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes; memory follows the group, not the list."""
        collecting = gc.isenabled()
        gc.disable()  # millions of small strings, no cycles
        try:
            return self._encode_all(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) <= SEGMENT):
                size += len(texts[end])
                end += 1
            if size > 2 * SEGMENT and self.cuts and not self._has_added(texts[at]) and (self.chunk is word_chunk or not _UNSAFE.search(texts[at])):
                out.append(b"".join(self._group([s])[0] for s in segments(texts[at])))
            else:
                out += self._group(texts[at:end])
            at = end
        return out

    def _group(self, texts: list[str]) -> list[bytes]:
        cut = [None if self._has_added(t) else self.keys(t) for t in texts]
        get = self.hot.get
        found = [None if keys is None else list(map(get, keys)) for keys in cut]
        missing = {k for keys, ids in zip(cut, found, strict=True) if ids is not None and None in ids for k, i in zip(keys, ids, strict=True) if i is None}
        if not missing:
            return [self._whole(t) if ids is None else b"".join(ids) for t, ids in zip(texts, found, strict=True)]
        fresh = self._learn(missing)
        out = []
        for t, keys, ids in zip(texts, cut, found, strict=True):
            if ids is None:
                out.append(self._whole(t))
            elif None in ids:
                out.append(b"".join([fresh[k] if i is None else i for k, i in zip(keys, ids, strict=True)]))
            else:
                out.append(b"".join(ids))
        return out


_encoders: dict[tuple[str, bool], ChunkEncoder] = {}
CACHES.append(_encoders)


def encoder(path: str, special: bool = False) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file."""
    if (path, special) not in _encoders:
        _encoders[path, special] = ChunkEncoder(path, special)
    return _encoders[path, special]
