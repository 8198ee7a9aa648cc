"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens.  It starts with one state and an arc for every base symbol; each
merge (u, v) then adds one gadget: the arcs labelled u lead to a copy of their old target that
has lost its arc v, and every state with an arc u gets an arc uv to the target of v.  The copies
are stored as what they lost, which makes the table linear in the number of merges; a lookup
walks that table and is kept.  After all merges, exactly one path spells each word: its BPE encoding.  A word is
encoded by following arcs along its symbols, and decoded by emitting the labels of the arcs.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from docweave.llm.common import sha256_hex, small_batches
from docweave.llm.rolling import text_buffers


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [], 0
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


#: Stands for the word-end mark while a word is spelled; no symbol of the byte alphabet.
_END = "\n"


class TokenAutomaton:
    """Deterministic automaton over tokens, built by successive merge gadgets.

    All arcs with one label share a target at any time.  The target of u's arcs after some merges
    is the target that u was born with (its right part's at that time), less the labels v of the
    merges (u, v) so far; so a state is named by a label and a number of merges.
    """

    def __init__(self, base: Iterable[str], merges: Iterable[tuple[str, str]], word_end: str):
        self.word_end = word_end
        self.label: list[str] = []
        self.number: dict[str, int] = {}
        self.born: list[int] = []  # merge that made the label; -1 for base symbols
        self.left: list[int] = []
        self.right: list[int] = []
        self.first: list[int] = []  # first merge whose left part is this label
        self.lost: dict[int, int] = {}  # u and v of a merge: its number
        for symbol in base:
            self._add(symbol, -1, -1, -1)
        never: set[str] = set()
        for k, (a, b) in enumerate(merges):
            if a + b in self.number or a + b in never:
                raise ValueError(f"merge {k} makes a known token: {a!r} {b!r}")
            u, v = self.number.get(a), self.number.get(b)
            if (u is None and a not in never) or (v is None and b not in never):
                raise ValueError(f"merge {k} joins unknown parts: {a!r} {b!r}")
            if u is None or v is None or not self._walk(u, v, k):
                never.add(a + b)  # no state has the arcs u, v in a row, so the merge has nothing to join
                continue
            self.lost[u << 20 | v] = k
            self.first[u] = min(self.first[u], k)
            self._add(a + b, k, u, v)
        # every start of a label: the label's number, or -1 where only longer labels start so
        ends = {(t[: -len(word_end)] + _END if t.endswith(word_end) else t): i for t, i in self.number.items()}
        self.table = {t[:i]: -1 for t in ends for i in range(1, len(t))} | ends
        self._seen: dict[int, bool] = {}

    def _add(self, text: str, born: int, left: int, right: int) -> None:
        self.number[text] = len(self.label)
        self.label.append(text)
        self.born.append(born)
        self.left.append(left)
        self.right.append(right)
        self.first.append(1 << 30)

    def has_arc(self, after: int, token: int) -> bool:
        """Whether the state that arcs labelled ``after`` lead to, after all merges, has an arc ``token``."""
        key = after << 20 | token
        known = self._seen.get(key)
        if known is None:
            known = self._walk(after, token)
            if len(self._seen) > 1_000_000:
                self._seen.clear()
            self._seen[key] = known
        return known

    def _walk(self, u: int, t: int, merges: int = 1 << 30) -> bool:
        """The same after so many merges."""
        born, first, lost = self.born, self.first, self.lost
        while True:
            if lost.get(u << 20 | t, merges) < merges:
                return False
            if first[u] <= born[t] and first[u] < merges:
                # a copy made before t was born: it got the arc t if it had t's left part
                merges = min(merges, born[t] + 1)
                t = self.left[t]
            elif born[u] >= 0:
                u, merges = self.right[u], born[u]
            else:
                return True

    def encode(self, word: str) -> list[int]:
        """Labels of the only path that spells the word and its end mark, by number.

        The longest arcs are tried first.  What can follow depends on the place and the last arc
        alone, so a place found dead after an arc is not tried again: the work is linear.
        """
        text, table, seen = word + _END, self.table, self._seen
        n, path, places, options, dead = len(text), [], [0], [], None
        while True:
            i = places[-1]
            if i == n:
                return path
            if len(options) < len(places):
                found = []
                for j in range(i + 1, n + 1):
                    t = table.get(text[i:j])
                    if t is None:
                        break
                    if t >= 0:
                        found.append((t, j))
                options.append(found)
            choices, last = options[-1], path[-1] if path else -1
            while choices:
                t, j = choices.pop()
                if last >= 0:
                    ok = seen.get(last << 20 | t)
                    if not (self.has_arc(last, t) if ok is None else ok):
                        continue
                if dead is None or (t, j) not in dead:
                    path.append(t)
                    places.append(j)
                    break
            else:
                if not path:
                    raise ValueError(f"no path spells {word!r}")
                dead = dead or set()
                dead.add((path.pop(), places.pop()))
                options.pop()


_SEPARATORS = regex.compile(r"[\x1c-\x1f]")


class _Known(dict):
    """Words met so far; emptied when full, and long words are not kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        found = self.make(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = found
        return found


class WordBpe:
    """A word-end BPE vocabulary file: splitting, automaton and the texts of its arcs."""

    def __init__(self, path: str, most_cached: int = 250_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or spec.get("decoder"):
            raise ValueError("only BPE vocabularies with word ends and without a decoder are read")
        end, letters = model["end_of_word_suffix"], byte_alphabet()
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        base = [x for b in letters for x in (b, b + end)]
        self.automaton = TokenAutomaton(base, merges, end)
        self.letters = dict(enumerate(letters))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        self.ids = [str(self.vocab[x]) for x in self.automaton.label]
        self.words, self.known = _Known(self._word, most_cached), _Known(self._token, most_cached)

    def _word(self, word: str) -> tuple[str, str, int]:
        plain = word.isascii() and word.isprintable()  # such bytes stand for themselves
        path = self.automaton.encode(word if plain else word.encode("utf-8").decode("latin-1").translate(self.letters))
        ids, labels = self.ids, self.automaton.label
        return " ".join([ids[x] for x in path]), " ".join([labels[x] for x in path]), len(path)

    def _token(self, token: str) -> tuple[str, str, int]:
        """All words of a run without white space."""
        if token.isalpha():
            return self.words[token]
        found = [self.words[w] for w in self.pattern.findall(token)]
        return " ".join([x[0] for x in found]), " ".join([x[1] for x in found]), sum([x[2] for x in found])

    def _spaced(self, text: str) -> str:
        """The normalised text with one space, and no other white space, between its runs."""
        if text.isascii():
            text = text.lower()
            if not _SEPARATORS.search(text):
                return text.strip()  # the rest is left to the splitting of the batch
        else:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # no word crosses white space; str.split also cuts at the four separators, which are no white space to the pattern
        runs = text.split() if not _SEPARATORS.search(text) else filter(None, regex.split(r"[^\S\x1c-\x1f]+", text))
        return " ".join(runs)

    def encode(self, text: str) -> tuple[str, str, int]:
        """Ids joined by spaces, decoded text, and the number of tokens of a whole text."""
        pieces = []
        for part in self.cut.split(text) if self.cut is not None and "<" in text else [text]:
            if part in self.special:
                pieces.append((str(self.special[part]), part, 1))
            elif part:
                pieces += map(self.known.__getitem__, filter(None, regex.split(r"[ \t\n\r\f\v]+", self._spaced(part))))
        pieces = [x for x in pieces if x[2]]
        if not pieces:
            return "", "", 0
        ids, labels, counts = zip(*pieces, strict=True)
        return " ".join(ids), " ".join(labels), sum(counts)

    def encode_all(self, texts: list[str]) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Ids, decoded texts and numbers of tokens of many texts: each different run is encoded once, and the texts are put together from the runs' numbers."""
        whole = {i: self.encode(t) for i, t in enumerate(texts) if self.cut is not None and "<" in t and self.cut.search(t)}
        lists = pc.ascii_split_whitespace(pa.array(["" if i in whole else self._spaced(t) for i, t in enumerate(texts)], pa.large_string()))
        runs = lists.flatten().dictionary_encode()
        names, known = runs.dictionary.to_pylist(), self.known
        spelled = list(zip(*[known[t] if t else ("", "", 0) for t in names], strict=True)) or [(), (), ()]
        place, offsets = runs.indices, lists.offsets
        counts = np.array(spelled[2], np.int64)
        if any(names[i] for i in np.flatnonzero(counts == 0)):  # a run without a token would leave two spaces
            spelled = zip(*map(self.encode, texts), strict=True)
            return tuple(f(x) for f, x in zip((*[lambda x: pa.array(x, pa.large_string())] * 2, np.array), spelled, strict=True))
        text_of = lambda j: pc.binary_join(type(lists).from_arrays(offsets, pa.array(spelled[j], pa.large_string()).take(place)), pa.scalar(" ", pa.large_string()))
        ends = np.concatenate([[0], np.cumsum(counts[np.asarray(place)])])
        borders = np.asarray(offsets)
        ids, labels, numbers = text_of(0), text_of(1), ends[borders[1:]] - ends[borders[:-1]]
        if whole:
            rows = [list(x) for x in (ids.to_pylist(), labels.to_pylist())]
            for i, (a, b, n) in whole.items():
                rows[0][i], rows[1][i], numbers[i] = a, b, n
            ids, labels = (pa.array(x, pa.large_string()) for x in rows)
        return ids, labels, numbers


_loaded: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """The tokenizer of a vocabulary file, built once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _digests(column: pa.Array) -> list[str]:
    data, offsets = text_buffers(column)
    return [sha256_hex(data[a:z]) for a, z in zip(offsets[:-1], offsets[1:], strict=True)]


def encode_documents(docs: DataFrame, vocabulary: str, keep_text: bool = True) -> DataFrame:
    """Token ids and decoded text (or their digests) of each row of ``docs``.

    Returns doc_id, n_tokens, ids_sha256 and decoded_sha256, and with ``keep_text`` also ids
    (decimal, joined by spaces) and decoded.  Each row is on its own: no shuffle, repeated rows give repeated results, a
    null text is an empty one (no tokens), texts of any length are handled whole, an empty table
    gives an empty result, and further columns of ``docs`` are not read.  No two merges tie: each
    pair of parts has one rank, and of equal pairs in a word the first is joined first.  ``vocabulary`` is a path that each worker can read.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids string, decoded string" if keep_text else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(vocabulary)
        for batch in small_batches(batches, most=1 << 22):
            ids, decoded, n = bpe.encode_all([t or "" for t in batch.column("text").to_pylist()])
            arrays = [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(_digests(ids), pa.string()), pa.array(_digests(decoded), pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_text:
                arrays += [ids.cast(pa.string()), decoded.cast(pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_ids(path: str, ids: Iterable[int]) -> str:
    """Emits the labels of the arcs that the ids name, joined as the vocabulary's library does."""
    bpe = tokenizer(path)
    if not hasattr(bpe, "labels"):
        bpe.labels = {i: t for t, i in bpe.vocab.items()} | {i: t for t, i in bpe.special.items()}
    return " ".join(bpe.labels[i] for i in ids)
