"""Tokenizing through bounded per-worker caches of words.

The three tokenizers here never join text across a single space that has no other white space
beside it: the tokens of a text are those of its first piece followed by those of " piece" for each
later one. Texts are cut at those spaces, whatever else they hold, by Arrow's own loops; a piece
that holds other white space is one word. Every distinct piece of a slice is looked up
once, and ids are gathered by number. Pieces not yet known are encoded by the library, many in one call.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words held by each of the two generations of a cache.
GENERATION = 150_000
#: Longer words are encoded anew each time.
LONGEST = 64
#: Punctuation that, after a word, begins a token of its own.
AFTER = ".,!?;:#$%&*|)"
#: Texts encoded at once, in characters; a longer text is taken alone.
AT_ONCE = 4 << 20
#: Pieces whose ids are gathered at once.
GATHERED = 1 << 17
#: Characters that may mark cuts; one that no text of a slice has is taken.
MARKS = ["\x01", "\x02", "\x03", "\x04", *map(chr, range(0xFDD0, 0xFDF0))]

# White space other than space and newline, in the widest reading of the word, a sign that stands for a space, or a
# space beside white space or an end.
_ODD = r"  | \n|\n |^ | $|[\x{2581}\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SAFE = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


class Generations:
    """A mapping of at most 2 x ``size`` words that keeps what was used lately."""

    def __init__(self, size: int = GENERATION):
        self.size, self.young, self.old = size, {}, {}

    def values(self, words: list[str], make: Callable[[list[str]], Iterable]) -> list:
        """The values of distinct words; ``make`` gives those of unknown ones. Long words are not kept."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out = list(map(young.get, words))
        unknown = []
        for i in (i for i, value in enumerate(out) if value is None):
            value = out[i] = old.get(words[i])
            if value is None:
                unknown.append(i)
            else:
                young[words[i]] = value
        if unknown:
            for i, value in zip(unknown, make([words[i] for i in unknown]), strict=True):
                out[i] = value
                if len(words[i]) <= LONGEST:
                    young[words[i]] = value
        return out


def portions(texts: list[str | None], most: int = AT_ONCE) -> Iterator[list[str | None]]:
    """The texts in portions of at most ``most`` characters, one text at least."""
    begin = size = 0
    for end, text in enumerate(texts):
        if size and size + len(text or "") > most:
            yield texts[begin:end]
            begin, size = end, 0
        size += len(text or "")
    if begin < len(texts):
        yield texts[begin:]


def cut_at_spaces(texts: pa.Array, keep_space: bool) -> pa.ListArray:
    """The pieces of every text between lone spaces; with ``keep_space``, later pieces begin with theirs.

    Other spaces stay inside pieces. A null text has no pieces, an empty one has an empty piece.
    """
    mark = next((m for m in MARKS if not pc.any(pc.match_substring(texts, m)).as_py()), None)
    if mark is None:  # texts made to hold all of them: each is a piece
        return pa.ListArray.from_arrays(pa.array(range(len(texts) + 1), pa.int32()), texts.fill_null(""))
    after = mark + " " if keep_space else mark
    odd = pc.match_substring_regex(texts, _ODD).fill_null(False)
    marked = pc.replace_substring(texts, " ", after)
    if pc.any(odd).as_py():
        by_hand = [_SAFE.sub(after, t) for t in texts.filter(odd).to_pylist()]
        marked = pc.replace_with_mask(marked, odd, pa.array(by_hand, marked.type))
    return pc.split_pattern(marked, mark)


def gather(source: np.ndarray, begins: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches ``which`` of ``source``, one after another."""
    n = lengths[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return source[np.arange(total) + np.repeat(begins[which] - (ends - n), n)]


class WordEncoder:
    """Token ids, as bytes of unsigned numbers, of whole texts under a ``tokenizers`` model.

    ``spaces``: whether a word's tokens depend on the space before it (byte-level models).
    The result is the library's own for the whole text.
    """

    def __init__(self, tokenizer_json: str, spaces: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.spaces = spaces
        wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.dtype = np.dtype("<u4" if wide else "<u2")
        self.cores, self.tails, self.ends = Generations(), Generations(10_000), {"": False}
        self.lower = self.whole("AÉ") == self.whole("aé")
        # Tokens that begin with a space, or that end a word.
        self.edge = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.edge[i] = token.startswith("Ġ") if spaces else token.endswith("</w>")
        # A special token between words keeps them apart in one call to the library.
        self.mark, self.mark_id = max(
            ((t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special),
            key=lambda x: x[1], default=("", -1),
        )

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def ends_a_word(self, letter: str) -> bool:
        """Whether punctuation after this character begins a token of its own; the library is asked.

        It does not where normalizing turns the character into a letter and a mark, for instance.
        """
        if letter not in self.ends:
            if len(self.ends) > 10_000:
                self.ends = {"": False}
            normal, parts = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
            text = f"a{letter}."
            text = normal.normalize_str(text) if normal else text
            self.ends[letter] = letter.isalnum() and parts.pre_tokenize_str(text)[-1][0] == "."
        return self.ends[letter]

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, one after another, and how many each has.

        A word and the punctuation after it are tokenized apart, and few words are new without it.
        """
        core = pc.utf8_rtrim(words, AFTER)
        last = pc.utf8_slice_codeunits(core, -1).dictionary_encode()
        safe = np.array([self.ends_a_word(c) for c in last.dictionary.to_pylist()], bool)
        safe = safe[last.indices.to_numpy()] if len(safe) else np.zeros(len(words), bool)
        safe &= ~pc.or_(pc.match_substring(words, "<|"), pc.match_substring(words, "|>")).to_numpy(zero_copy_only=False)
        core = pc.if_else(pa.array(safe), core, words)
        cut = pc.subtract(pc.utf8_length(words), pc.utf8_length(core)).to_numpy()
        if self.lower:
            plain = pc.match_substring_regex(core, r"^[\x00-\x{12f}]*$")
            core = pc.if_else(plain, pc.utf8_lower(core), core)
        core = core.dictionary_encode()
        which = np.stack([core.indices.to_numpy(), np.zeros(len(words), "i4")], 1)
        values = self.cores.values(core.dictionary.to_pylist(), self._encoded)
        values.append(b"")
        which[:, 1] = len(values) - 1
        for n in np.unique(cut[cut > 0]).tolist():
            at = cut == n
            tail = pc.utf8_slice_codeunits(words.filter(pa.array(at)), -n).dictionary_encode()
            which[at, 1] = tail.indices.to_numpy() + len(values)
            values += self.tails.values(tail.dictionary.to_pylist(), lambda some: map(self.whole, some))
        lengths = np.fromiter(map(len, values), "i8", len(values)) // self.dtype.itemsize
        ids = np.frombuffer(b"".join(values), self.dtype)
        return gather(ids, np.cumsum(lengths) - lengths, lengths, which.ravel()), lengths[which].sum(1)

    def _encoded(self, words: list[str]) -> Iterator[bytes]:
        """Encode words joined by spaces, many in one call, where the ids tell them apart."""
        def plain(w: str) -> bool:
            return w[:1] == " " and "<|" not in w and "|>" not in w if self.spaces else w.isalpha()

        some = [w for w in words if plain(w)]
        found: dict[str, bytes] = {}
        for begin in range(0, len(some), 256):
            found.update(zip(some[begin : begin + 256], self._joined(some[begin : begin + 256]), strict=True))
        rest = [w for w in words if w not in found]
        found.update(zip(rest, self._marked(rest), strict=True))
        return map(found.__getitem__, words)

    def _joined(self, words: list[str]) -> list[bytes]:
        text = ("" if self.spaces else " ").join(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        at = np.flatnonzero(self.edge[ids])
        if len(at) != len(words):
            return self._marked(words)
        begins = at if self.spaces else np.append(0, at[:-1] + 1)
        return [ids[a:b].tobytes() for a, b in zip(begins.tolist(), np.append(begins[1:], len(ids)).tolist(), strict=True)]

    def _marked(self, words: list[str]) -> list[bytes]:
        """Encode words with a special token between them."""
        out: list[bytes] = []
        for begin in range(0, len(words), 256):
            some = words[begin : begin + 256]
            if not self.mark or any("<|" in w or "|>" in w for w in some):
                out += [self.whole(w) for w in some]
                continue
            ids = np.array(
                self.tokenizer.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)[0].ids, self.dtype)
            cuts = np.flatnonzero(ids == self.mark_id)
            begins, ends = np.append(0, cuts + 1), np.append(cuts, len(ids))
            out += [ids[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One value per text; null counts as empty."""
        out = [ids for some in portions(texts) for ids in self._slice(some)]
        pa.default_memory_pool().release_unused()  # a worker is kept, and other stages need the memory
        return out

    def _slice(self, texts: list[str | None]) -> list[bytes]:
        strings = pa.array([t or "" for t in texts], pa.large_string())
        # Where the space does not count, white space of any kind only parts words.
        lists = cut_at_spaces(strings, True) if self.spaces else pc.ascii_split_whitespace(strings)
        pieces = lists.flatten().dictionary_encode()
        ids, lengths = self._pieces(pieces.dictionary)
        which = pieces.indices.to_numpy()
        offsets, begins = lists.offsets.to_numpy(), np.cumsum(lengths) - lengths
        out: list[bytes] = []
        first = 0
        while first < len(texts):
            # Texts of up to so many pieces, one at least.
            end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + GATHERED, "right")) - 1)
            some = which[offsets[first] : offsets[end]]
            flat = gather(ids, begins, lengths, some).tobytes()
            upto = np.append(0, np.cumsum(lengths[some]))[offsets[first : end + 1] - offsets[first]] * self.dtype.itemsize
            out += [flat[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
            first = end
        return out
