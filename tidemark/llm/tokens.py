"""Token ids of whole texts by a byte-level BPE of the tokenizers library.

The library's own pipeline spends several microseconds on every word, seen before or not. Here a text is cut
before single spaces, where no token of this kind of pre-tokenizer can reach across, and a worker remembers
the ids of pieces. A new piece is cut by the tokenizer's own pattern and each part merged by the library's
BPE model. Texts with white space in which a token may span the cut, texts that hold an added token of the
tokenizer, and all texts of a tokenizer of another kind go through the library whole. So the ids are those of
the library's own encoding of the whole text, without the tokens that it would add around it.

``encode_all`` does this for many texts at once and remembers nothing: the pieces of a group of texts are told
apart by Arrow, their parts merged once in large calls of the BPE model, and the ids put together by Arrow.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

from .common import load_tokenizer, release_memory

#: Pieces a worker remembers, 250 bytes each; when full it starts anew.
CACHE_PIECES = 500_000
#: Characters of texts whose pieces are told apart together (a longer text alone), parts and bytes merged in one call.
GROUP_CHARS, MERGE_PARTS, MERGE_BYTES = 1 << 23, 4096, 1 << 20
_MARKS = frozenset(".,;:!?")
#: The pattern of the library's byte-level pre-tokenizer, and white space other than space and \n.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that need no pattern: letters that every version of Unicode has, with marks behind them.
PLAIN = r"^(?P<lead>\n?)(?P<word> ?[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԧ一-龥]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)\z"
OTHER_SPACES = "\t\r\x0b\x0c\x85\xa0                　"


def _byte_level(tokenizer) -> bool:
    """Whether a tokenizer is plain byte-level BPE that cuts by ``PATTERN``."""
    from tokenizers import models, pre_tokenizers

    cut, model = tokenizer.pre_tokenizer, tokenizer.model
    if tokenizer.normalizer is not None or not isinstance(cut, pre_tokenizers.ByteLevel) or not isinstance(model, models.BPE):
        return False
    return not cut.add_prefix_space and cut.use_regex and not any((model.dropout, model.continuing_subword_prefix, model.end_of_word_suffix, model.byte_fallback, model.ignore_merges))


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE writes for each byte: itself where printable, else the next free one from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(free)) for b in range(256)}


class Pieces(dict):
    """Ids (little-endian unsigned 32-bit) of what follows a space, by text; of a text's start, by "\\n\\n" and the text."""

    def __init__(self, path: str):
        import regex

        self.tokenizer, self.parts, self.letters, self.most = load_tokenizer(path), {}, _byte_letters(), CACHE_PIECES
        self.merge, self.cut = self.tokenizer.model.tokenize, regex.compile(PATTERN).findall
        self.pieced, self.added = _byte_level(self.tokenizer), [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bulk = None

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        if piece.isalpha():  # letters, also with a mark behind them, need no pattern
            ids = self._merged(" " + piece)
        elif piece[-1:] in _MARKS and piece[:-1].isalpha():
            ids = self[piece[:-1]] + self._part(piece[-1])
        else:
            ids = b"".join(map(self._part, self.cut(piece[2:] if piece.startswith("\n\n") else " " + piece)))
        self[piece] = ids
        return ids

    def _merged(self, part: str) -> bytes:
        return array("I", [t.id for t in self.merge(self._letters(part))]).tobytes()

    def _merged_all(self, parts):
        """``_merged`` of each part of an Arrow array, many in one call: a part ends where as many bytes are written as it has."""
        import numpy as np
        import pyarrow as pa

        if self.bulk is None:
            from tokenizers import Tokenizer, pre_tokenizers

            self.bulk = Tokenizer(self.tokenizer.model)
            self.bulk.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            self.written = np.array([ord(self.letters[b]) for b in range(255)] + [ord("\n")], "<u2")  # no UTF-8 holds byte 255, no letter is \n
            vocabulary = self.tokenizer.get_vocab()
            self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        _, offsets, data = parts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[parts.offset : parts.offset + len(parts) + 1] if len(parts) else np.zeros(1, np.int64)
        data = np.frombuffer(data or b"", "u1")
        out, sizes, lo = [], [], 0
        while lo < len(parts):
            hi = max(lo + 1, min(lo + MERGE_PARTS, int(np.searchsorted(offsets, offsets[lo] + MERGE_BYTES, "right")) - 1))
            want = offsets[lo + 1 : hi + 1] - offsets[lo]
            letters = self.written[np.insert(data[offsets[lo] : offsets[hi]], want[:-1], 255)].tobytes().decode("utf-16-le")
            ids = np.array(self.bulk.encode_batch_fast([letters], add_special_tokens=False)[0].ids, "<u4")
            ends = np.concatenate(([0], np.cumsum(self.sizes[ids])))
            at = np.searchsorted(ends, want)
            if ends[-1] == want[-1] and (ends[at] == want).all():
                out.append(ids.tobytes())
                sizes.append(4 * np.diff(at, prepend=0))
            else:  # a vocabulary without some byte
                one = [self._merged(p) for p in parts[lo:hi].to_pylist()]
                out.append(b"".join(one))
                sizes.append(np.array([len(x) for x in one]))
            lo = hi
        ends = np.concatenate(([0], *map(np.asarray, sizes))).astype(np.int64).cumsum()
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(out))])

    def _piece_ids(self, pieces):
        """Ids of each piece of an Arrow array, a space before it included: of line break, letters and marks by Arrow, of others part by part."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        found = pc.extract_regex(pieces, PLAIN)
        plain = found.is_valid()
        columns = [pc.struct_field(found.filter(plain), name) for name in ("lead", "word", "tail")]
        cuts = [self.cut(p) for p in pieces.filter(pc.invert(plain)).to_numpy(zero_copy_only=False)]
        coded = pa.concat_arrays([*columns, pa.array([x for c in cuts for x in c], pa.large_string())]).dictionary_encode()
        mask, n, sizes = plain.to_numpy(zero_copy_only=False), len(columns[0]), [0, *map(len, cuts)]
        del found, plain, columns, cuts
        ids = self._merged_all(coded.dictionary)
        joined = pc.binary_join_element_wise(*[ids.take(coded.indices[i * n : i * n + n]) for i in range(3)], pa.scalar(b"", pa.large_binary()))
        parts = ids.take(coded.indices[3 * n :])
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(parts).to_numpy(), dtype=np.int64)))[np.cumsum(sizes)]
        rest = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes) - 1, [None, pa.py_buffer(ends), parts.buffers()[2] or pa.py_buffer(b"")])
        return pa.concat_arrays([joined, rest]).take(pa.array(np.where(mask, np.cumsum(mask) - 1, n + np.cumsum(~mask) - 1), pa.int64()))

    def _part(self, part: str) -> bytes:
        """Ids of a part of a piece that has several; remembered, as they come back in other pieces."""
        if (found := self.parts.get(part)) is None:
            if len(self.parts) >= self.most:
                self.parts.clear()
            found = self.parts[part] = self._merged(part)
        return found

    def forget(self) -> None:
        """Drops what was remembered, so that an idle worker holds no cache through later stages."""
        self.clear()
        self.parts.clear()
        release_memory()

    def _letters(self, part: str) -> str:
        if part.isascii() and part[1:].isalpha() and (part[0] == " " or part[0].isalpha()):
            return "\u0120" + part[1:] if part[0] == " " else part
        return part.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)

    def _whole(self, text: str) -> bool:
        """Whether a text goes through the library whole."""
        if not self.pieced or any(a in text for a in self.added) or "  " in text or text[-1:] == " " or "\n " in text or " \n" in text or text[:2] == "\n\n":
            return True
        return (not text.isascii() or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text) and any(c in text for c in OTHER_SPACES)

    def _library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def encode(self, text: str) -> bytes:
        if self._whole(text):
            return self._library(text)
        head, *rest = text.split(" ")
        return (self["\n\n" + head] if head else b"") + b"".join(map(self.__getitem__, rest))

    def encode_all(self, texts: Iterable[str], most: int | None = None) -> Iterator[bytes]:
        """``encode`` of each text, in groups of ``most`` characters (none: ``GROUP_CHARS``)."""
        group, size, most = [], 0, most or GROUP_CHARS
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= most:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        whole = [self._whole(t) for t in texts]
        # a line break by itself is a part, too
        words = pc.split_pattern(pa.array((t if "\n\n" in t else t.replace("\n", " \n") for t, w in zip(texts, whole) if not w), pa.large_string()), " ")
        # every text has a piece at least, be it empty; the first has no space before it
        ends = np.cumsum(pc.list_value_length(words).to_numpy(), dtype=np.int64)
        firsts = np.concatenate(([0], ends))[: len(ends)].astype(np.int64)
        flat = words.flatten()
        found, heads = flat.dictionary_encode(), flat.take(pa.array(firsts))
        del words, flat  # what isn't needed any more goes, as all of it is as large as the texts
        known, at = found.dictionary, found.indices.to_numpy().copy()
        del found
        at[firsts] = len(known) + np.arange(len(firsts))
        spaced = pc.if_else(pc.starts_with(known, "\n"), known, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), known, pa.scalar("", pa.large_string())))
        pieces = pa.concat_arrays([spaced, heads])
        del known, spaced, heads
        joined = self._piece_ids(pieces).take(pa.array(at))
        del pieces, at
        data = memoryview(joined.buffers()[2] or b"")
        bounds = iter(np.frombuffer(joined.buffers()[1], np.int64)[ends].tolist() if len(ends) else ())
        lo = 0
        for text, w in zip(texts, whole):
            if w:
                yield self._library(text)
            else:
                hi = next(bounds)
                yield bytes(data[lo:hi])
                lo = hi


_PIECES: dict[str, Pieces] = {}


def encoder(path: str, most: int = CACHE_PIECES) -> Pieces:
    """The worker's encoder, set to remember at most so many pieces."""
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    _PIECES[path].most = most
    return _PIECES[path]
