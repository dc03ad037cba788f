"""Token ids of the tokenizers library, each distinct chunk of text encoded once per worker.

Both kinds of file split a text before they merge, and never between a letter and a mark that is
neither letter, apostrophe nor digit, nor between a visible mark and a space or newline, nor between a
single newline and a visible mark. Texts of
plain Latin letters are cut at some of these borders; other texts only at a single space between ASCII
letters or digits, which is a border for any such splitter. What lies between borders is encoded by
the library itself and remembered, up to a bound. Arrow cuts and counts the chunks, so Python
touches a chunk once per slice of text and not once per occurrence.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

KEPT_CHUNKS = 400_000
KEPT_LENGTH = 48
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_UNCOMMON = rf"[^ -~\n{_LETTERS}]|<\|"  # the latter begins a special token, which has letters and marks
_IRREGULAR = rf"[ \n][ \n]|[^{_LETTERS}][.,][ \n]|^[.,][ \n]"
_MARK = "\x00"
_AFTER_LETTERS = rf"([{_LETTERS}])([^{_LETTERS}' \n]*)([ \n])"
_AFTER_MARKS = rf"([^{_LETTERS} \n{_MARK}])([ \n])"
_SURE_BORDER = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")
_WORD = re.compile(rf" ?[{_LETTERS}]+")


def chunks_of(texts: pa.Array) -> pa.Array:
    """Each text as a list of pieces that no token crosses; joined, the pieces are the text. Most
    texts have single spaces and a letter before each full stop, and need no patterns."""
    texts = texts.cast(pa.large_string())
    uncommon = pc.match_substring_regex(texts, _UNCOMMON)
    irregular = pc.or_(uncommon, pc.match_substring_regex(texts, _IRREGULAR))
    marked = texts.filter(pc.invert(irregular))
    for plain, cut in ((" ", f"{_MARK} "), ("\n", f"{_MARK}\n{_MARK}"), (f".{_MARK}", f"{_MARK}.{_MARK}"), (f",{_MARK}", f"{_MARK},{_MARK}")):
        marked = pc.replace_substring(marked, plain, cut)
    if len(marked) == len(texts):
        return pc.split_pattern(marked, _MARK)
    matched = texts.filter(pc.and_(irregular, pc.invert(uncommon)))
    matched = pc.replace_substring_regex(matched, _AFTER_LETTERS, rf"\1{_MARK}\2{_MARK}\3")
    matched = pc.replace_substring_regex(matched, _AFTER_MARKS, rf"\1{_MARK}\2")
    odd = [_SURE_BORDER.split(text) for text in texts.filter(uncommon).to_pylist()]
    parts = [pc.split_pattern(marked, _MARK), pc.split_pattern(matched, _MARK), pa.array(odd, pa.large_list(pa.large_string()))]
    parts = [part.cast(pa.large_list(pa.large_string())) for part in parts]
    kind = irregular.to_numpy(zero_copy_only=False).astype(int) + uncommon.to_numpy(zero_copy_only=False)
    return pa.concat_arrays(parts).take(pa.array(np.argsort(np.argsort(kind, kind="stable"), kind="stable")))


class ChunkMemo:
    """Texts to ids through ``encode``, which maps chunks to one byte string of ids each."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self.encode = encode
        self.kept: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as little-endian unsigned 32-bit, and where each text's ids begin (one more at the end)."""
        lists = chunks_of(texts)
        rows = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(rows[0], rows[-1] - rows[0]).dictionary_encode()
        pieces = self._of_chunks(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(pieces), dtype="<u4")
        length = np.fromiter(map(len, pieces), np.int64, len(pieces)) >> 2
        start = np.concatenate(([0], np.cumsum(length)[:-1])) if len(pieces) else length
        codes = coded.indices.to_numpy()
        lengths = length[codes]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        kind = np.int32 if max(ends[-1], len(flat)) < 1 << 31 else np.int64
        places = np.repeat((start[codes] - ends[:-1]).astype(kind), lengths)
        places += np.arange(len(places), dtype=kind)
        return flat[places], ends[rows - rows[0]]

    def _of_chunks(self, chunks: list[str]) -> list[bytes]:
        kept = self.kept
        found = list(map(kept.get, chunks))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if not lacking:
            return found
        older = [self.before.get(chunks[i]) for i in lacking]
        missing = [chunks[i] for i, ids in zip(lacking, older, strict=True) if ids is None]
        fresh = dict(zip(missing, self.encode(missing), strict=True)) if missing else {}
        for i, ids in zip(lacking, older, strict=True):
            found[i] = fresh[chunks[i]] if ids is None else ids
        kept.update((chunks[i], found[i]) for i in lacking if len(chunks[i]) <= KEPT_LENGTH)
        if len(kept) > KEPT_CHUNKS // 2:
            # What isn't met again while the next half fills is forgotten; frequent chunks stay.
            self.before, self.kept = kept, {}
        return found


_MEMOS: dict[str, ChunkMemo] = {}


def _spelling(library) -> dict[int, str] | None:
    """What the library's normaliser and splitter make of each plain letter and of a space before a
    word, as a table for ``str.translate``; None where a word isn't spelled letter by letter."""

    def shown(text: str) -> list[str]:
        text = library.normalizer.normalize_str(text) if library.normalizer else text
        return [part for part, _ in library.pre_tokenizer.pre_tokenize_str(text)]

    letters = [chr(c) for c in range(0x100) if re.fullmatch(f"[{_LETTERS}]", chr(c))]
    table = {ord(c): "".join(shown(c)) for c in letters}
    alone, after_space = shown("a"), shown(" a")
    if len(alone) != 1 or len(after_space) != 1 or not after_space[0].endswith(alone[0]):
        return None
    table[ord(" ")] = after_space[0].removesuffix(alone[0])
    probe = ["".join(letters[i::7]) for i in range(7)]
    probe += [f" {word}" for word in probe]
    return table if all(shown(word) == [word.translate(table)] for word in probe) else None


def library_memo(path: str) -> ChunkMemo:
    """One memo for each file and worker. A plain word is one stretch for the library's splitter: it is
    spelled as the library spells it and goes straight to the library's merges. All else goes
    through the whole library."""
    if path not in _MEMOS:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        spelling, merges = _spelling(library), library.model

        def encode(chunks: list[str]) -> Iterable[bytes]:
            out: dict[str, bytes] = {}
            if spelling is not None:
                for c in filter(_WORD.fullmatch, chunks):
                    out[c] = array("I", [token.id for token in merges.tokenize(c.translate(spelling))]).tobytes()
            others = [c for c in chunks if c not in out]
            for i in range(0, len(others), 1000):
                part = others[i : i + 1000]
                encodings = library.encode_batch_fast(part, add_special_tokens=False)
                out.update((c, np.array(e.ids, dtype="<u4").tobytes()) for c, e in zip(part, encodings, strict=True))
            return [out[c] for c in chunks]

        _MEMOS[path] = ChunkMemo(encode)
    return _MEMOS[path]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
