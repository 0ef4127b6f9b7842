"""Word BPE by a tokenization automaton (operator 11).

The merges of a tokenizer file are compiled, one after the other, into a
deterministic automaton over tokens: from its start state every word has
exactly one path, whose arc labels are the word's tokens. At first there is
one state with an arc for every symbol. The gadget of a merge ``u v -> uv``

* gives ``u`` a new target, a copy of its old one without the arc ``v``;
* adds the arc ``uv``, to the old target of ``v``, to every state that has ``u``.

A copy is stored as its parent and the arc it lacks, so the automaton takes a
few numbers per merge. The arcs of a state are worked out when it is first
reached and kept as a row of bits.

Words are encoded by table look-ups only, all new words of a slice side by
side: for each place reached, a trie walks the following bytes, and of the
tokens that end at a place the one that is an arc of the state it starts from
gives that place its state. Decoding emits the label of each arc.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar.llm.text import batches_of_texts

CACHE_WORDS = 400_000  # words a generation of a Python worker's cache holds
CELLS = 1 << 22  # bytes of words, padded, that are encoded side by side
START, FINAL = 0, 1
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable bytes for themselves, the others,
    in order, for the code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + other.index(b)) for b in range(256)]


class MergeAutomaton:
    """The automaton of a BPE vocabulary whose last symbol of a word carries a suffix."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        byte_of = {c: i for i, c in enumerate(byte_symbols())}
        size = max(vocab.values()) + 1
        self.labels = [""] * size
        self.born = np.zeros(size, np.int64)  # merge that made a token, from 1; 0 for symbols
        self.left = np.full(size, -1, np.int64)
        self.target = np.full(size, -1, np.int64)
        spelled: list[tuple[bytes, bool]] = [(b"", False)] * size
        for token, i in vocab.items():
            ends = token.endswith(suffix)
            spelled[i] = (bytes(byte_of[c] for c in (token[:-len(suffix)] if ends else token)), ends)
            self.labels[i] = token
        made = {a + b for a, b in merges}
        symbols = [i for token, i in vocab.items() if token not in made]
        if len(made) != len(merges) or any(len(spelled[i][0]) != 1 for i in symbols):
            raise ValueError("every token must be one symbol or come from one merge")
        for i in symbols:
            self.target[i] = FINAL if spelled[i][1] else START
        self._compile([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
        self._spell([(word, ends, i) for i, (word, ends) in enumerate(spelled) if self.target[i] >= 0])
        self.row_of = np.full(len(self.parent), -1, np.int64)
        self.rows = np.zeros((64, (size + 7) // 8), np.uint8)
        self.n_rows = 0
        self._reach(np.array([START]))

    def _compile(self, merges: list[tuple[int, int, int]]) -> None:
        """Apply the gadget of every merge in turn."""
        parent, removed, since = [-1, -1], [-1, -1], [0, 0]
        left, born, target = [-1] * len(self.labels), [0] * len(self.labels), self.target.tolist()
        for m, (u, v, uv) in enumerate(merges, 1):
            if (target[u] < 0 and born[u] == 0) or (target[v] < 0 and born[v] == 0) or target[uv] >= 0:
                raise ValueError("a merge must follow those that make its parts")
            left[uv], born[uv] = u, m
            # v is an arc of u's target unless a copy left it out, or something that v grew from on its left
            lost, x, before = {}, v, m
            while x >= 0:
                lost[x], before, x = before, born[x], left[x]
            s = target[u] if target[v] >= 0 else -1
            has = s >= 0 and s != FINAL
            while has and s > FINAL:
                has, s = not since[s] <= lost.get(removed[s], -1), parent[s]
            if not has:
                continue  # no word ever meets this pair: the merge adds no arc
            target[uv] = target[v]
            parent.append(target[u])
            removed.append(v)
            since.append(m)
            target[u] = len(parent) - 1
        self.parent, self.removed, self.since = parent, removed, since
        self.left, self.born, self.target = np.array(left), np.array(born), np.array(target)
        depth = [0] * len(left)  # how often a token grew to the right
        for _, _, uv in merges:
            depth[uv] = depth[left[uv]] + 1
        self.depths = [np.flatnonzero(np.array(depth) == d) for d in range(1, max(depth) + 1)]

    def _spell(self, tokens: list[tuple[bytes, bool, int]]) -> None:
        """Trie over the tokens' bytes: child table, and the token that ends at a node, inside or at the end of a word."""
        nodes: dict[bytes, int] = {b"": 1}
        for word, _, _ in sorted(tokens):
            for k in range(1, len(word) + 1):
                nodes.setdefault(word[:k], len(nodes) + 1)
        self.child = np.zeros((len(nodes) + 1, 256), np.int32)  # node 0: nowhere
        for word, i in nodes.items():
            if word:
                self.child[nodes[word[:-1]], word[-1]] = i
        self.token = np.full((2, len(nodes) + 1), -1, np.int32)
        for word, ends, i in tokens:
            self.token[int(ends), nodes[word]] = i
        self.length = np.zeros(len(self.labels), np.int64)
        for word, _, i in tokens:
            self.length[i] = len(word)

    def arcs(self, state: int) -> np.ndarray:
        """Whether each token is an arc of the state."""
        if state == FINAL:
            return np.zeros(self.target.size, bool)
        never = np.iinfo(np.int64).max
        gone = np.full(self.target.size, never)  # when the copies that led to this state lost an arc
        while state > FINAL:
            gone[self.removed[state]] = self.since[state]
            state = self.parent[state]
        for tokens in self.depths:  # a token never came if what it grew from was gone by then
            gone[tokens] = np.where(gone[self.left[tokens]] <= self.born[tokens], 0, gone[tokens])
        return (gone == never) & (self.target >= 0)

    def _reach(self, states: np.ndarray) -> None:
        """Work out the rows of states that are met for the first time."""
        for s in np.unique(states[self.row_of[states] < 0]).tolist():
            if self.n_rows == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[self.n_rows] = np.packbits(self.arcs(s), bitorder="little")
            self.row_of[s] = self.n_rows
            self.n_rows += 1

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each (non-empty) word."""
        out: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        at = 0
        while at < len(order):
            n = max(1, CELLS // len(words[order[at]]))
            part = order[at:at + n]
            for i, ids in zip(part, self._encode([words[i] for i in part])):
                out[i] = ids
            at += n
        return out

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """``encode`` of words from the longest to the shortest."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        longest = int(size[0])
        data = np.frombuffer(b"".join(w.ljust(longest, b"\0") for w in words), np.uint8).reshape(-1, longest)
        token = np.full((longest + 1, len(words)), -1, np.int32)  # by the place where it ends
        row = np.full(len(words), self.row_of[START])  # of the state each word is in
        word, begin, node = (np.zeros(0, np.int64) for _ in range(3))
        active = len(words)
        for k in range(longest):
            while size[active - 1] <= k:
                active -= 1
            fresh = np.arange(active)
            word = np.concatenate([word, fresh])
            begin = np.concatenate([begin, row[:active]])
            node = np.concatenate([node, np.ones(active, np.int64)])
            node = self.child[node, data[word, k]]
            on = node > 0
            word, begin, node = word[on], begin[on], node[on]
            found = self.token[(size[word] == k + 1).view(np.int8), node]
            hit = np.flatnonzero(found >= 0)
            t = found[hit]
            hit = hit[(self.rows[begin[hit], t >> 3] >> (t & 7)) & 1 == 1]
            reached, t = word[hit], found[hit]
            if reached.size != active:
                raise ValueError("the automaton must have one path for each prefix of a word")
            token[k + 1, reached] = t
            states = self.target[t]
            self._reach(states)
            row[reached] = self.row_of[states]
            alive = size[word] > k + 1
            word, begin, node = word[alive], begin[alive], node[alive]
        # back from the end of each word
        place, index, steps = size.copy(), np.arange(len(words)), []
        while index.size:
            t = token[place[index], index]
            steps.append((index, t))
            place[index] -= self.length[t]
            index = index[place[index] > 0]
        who = np.concatenate([i for i, _ in steps[::-1]])
        ids = np.concatenate([t for _, t in steps[::-1]])[np.argsort(who, kind="stable")].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(who, minlength=len(words)))
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def decode(self, ids: np.ndarray) -> str:
        """The arc labels of the ids, in order, a space between two."""
        return " ".join(map(self.labels.__getitem__, ids.tolist()))


class WordCoder:
    """Ids of whole texts by a tokenizer file: words split at white space, each split further and run through the automaton.

    The file must drop white space and carry the end of a word in its last token. ASCII words are split here; for
    others the library's normaliser and splitter say what the automaton gets. Tokens that the file adds to its
    vocabulary are cut out of the raw text first. Each worker keeps the ids of the words it meets, in two
    generations of bounded size.
    """

    _loaded: dict[str, WordCoder] = {}
    #: how the file splits a word, for ASCII in lower case (fixed by the tokenizer file)
    _split = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
    _letters = re.compile(rb"[a-z]+").fullmatch

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if (model["type"] != "BPE" or not model["end_of_word_suffix"] or spec["decoder"] is not None
                or model.get("dropout") or model.get("continuing_subword_prefix")):
            raise ValueError(f"{path} is no BPE vocabulary with word ends")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = MergeAutomaton(model["vocab"], merges, model["end_of_word_suffix"])
        library = Tokenizer.from_file(path)
        self.normalise, self.pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.byte_of = {c: i for i, c in enumerate(byte_symbols())}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = {a.encode(): np.array([i], "<u4").tobytes() for a, i in added.items()}
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + b")").split
        labels = self.automaton.labels
        labels += [""] * (max(added.values(), default=-1) + 1 - len(labels))
        for a, i in added.items():
            labels[i] = a
        self.known: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordCoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _parts(self, word: bytes) -> list[bytes]:
        """What the automaton gets of a word without added tokens."""
        if word.isascii():
            return self._split(word.lower())
        pieces = self.pieces(self.normalise(word.decode("utf-8", "replace")))
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in pieces]

    def _add(self, words: list[bytes]) -> None:
        """Learn words that are not known."""
        split: list[tuple[bytes, list[bytes]]] = []
        for w in words:
            found = self.old.get(w)
            if found is not None:
                self.known[w] = found
            elif self._letters(w):
                split.append((w, [w]))
            else:
                split.append((w, [p for i, part in enumerate(self.cut(w))
                                  for p in ([part] if i % 2 else self._parts(part))]))
        fresh = list({p for _, parts in split for p in parts if p} - self.added.keys())
        ids = dict(zip(fresh, self.automaton.encode(fresh))) | self.added
        ids[b""] = b""
        for w, parts in split:
            self.known[w] = b"".join(map(ids.__getitem__, parts))

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; ``bytes.split`` splits at ASCII white space."""
        split = [(t.lower() if t.isascii() and b"<|" not in t else t).split() for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known, self.old = {b"": b""}, self.known
        self._add(list(set().union(*split).difference(self.known)))
        known = self.known
        return [b"".join(map(known.__getitem__, words)) for words in split]


def _schema(docs: DataFrame, columns: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), columns])


def encode_words(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the tokens of the whole text, as the tokenizer file says, without special ones around them.

    A null or empty text has no ids. Rows that repeat are encoded each; an
    empty table gives an empty result. A column named ``ids`` is replaced.
    """
    docs = docs.drop("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder.of(path)
        for part, texts in batches_of_texts(batches, text_col, raw=True):
            ids = [np.frombuffer(i, "<u4").astype(np.int32) for i in coder.ids(texts)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*part.schema.names, "ids"])

    return docs.mapInArrow(run, _schema(docs, "ids array<int>"))


def decode_words(docs: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the labels of the ids with a space between two; null or no ids give an empty text.

    An id that the file does not have is an error. A column named ``decoded`` is replaced.
    """
    docs = docs.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = WordCoder.of(path).automaton
        for b in batches:
            texts = [automaton.decode(np.array(i or [], np.int64)) for i in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=[*b.schema.names, "decoded"])

    return docs.mapInArrow(run, _schema(docs, "decoded string"))


def roundtrip_digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the number and SHA-256 of its ids and the SHA-256 of what they decode to.

    Ids and decoded texts stay in the task. Cases as in ``encode_words``; columns with a result's name are replaced.
    """
    docs = docs.drop(*DIGESTS)
    rest = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder.of(path)
        for part, texts in batches_of_texts(batches, text_col, raw=True):
            out: tuple[list, list, list] = ([], [], [])
            for ids in coder.ids(texts):
                out[0].append(len(ids) // 4)
                out[1].append(hashlib.sha256(ids).hexdigest())
                out[2].append(hashlib.sha256(coder.automaton.decode(np.frombuffer(ids, "<u4")).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in rest), *(pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.string(), pa.string())))],
                names=[*rest, *DIGESTS])

    kept = docs.select(*[f"`{c}`" for c in rest])
    return (docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
            .mapInArrow(run, _schema(kept, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")))
