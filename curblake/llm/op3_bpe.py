"""BPE encoding and decoding by a tokenization automaton.

The merge list is compiled by successive merge gadgets into a deterministic automaton over tokens.  At first
there is one state per base symbol and every symbol may follow every other.  The gadget of a merge
(u, v) -> w then

* adds a state after w, a copy of the state after v as it is at that moment,
* cuts the arc labelled v that leaves the state after u (u v may no longer stand side by side), and
* gives every state that still has an arc u an arc w to the new state.

After the last gadget the paths of the automaton are exactly the token sequences that applying the merges in
order produces, so a word has one accepting path, and so has each of its prefixes.  The gadgets are stored,
not expanded over all tokens (that table would have vocabulary^2 cells): a state keeps what it was copied
from and when, an arc label keeps the arc that it extends and when, and a cut keeps its time; `alive` reads
an arc off these records.

Encoding reads symbols, so the automaton is expanded over the configurations that words reach: the arcs that
are under way (the state each left, and the place in the trie of labels).  A cell of that transition table,
(configuration, symbol), holds the next configuration and the label of the one arc that ends there; a word
takes one look-up a symbol, and the labels are read back from its end.  Cells are made when first reached.
Decoding emits arc labels.

Words are normalised and pre-split as the vocabulary file says: runs of characters that are below U+0250 in small
letters, where all versions of Unicode agree and nothing composes, by an expression, and what lies between white space and holds
other characters by the tokenizer library's own normaliser and splitter, whose tables are those to match.
Each word is encoded once and remembered.

Null texts count as empty; an empty text has no tokens.  Lone surrogates, which no table can hold, count as
U+FFFD.  Repeated rows are encoded like any other, extra columns pass through `encode` untouched unless they
carry one of its output names.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import cached_property, lru_cache

import pandas as pd
from pyspark.sql import DataFrame

from curblake.llm.common import by_batch

TOKENIZER = "word_bpe_49k.json"
#: Distinct words, and table cells, that a Python worker remembers at once.
MEMORY = 200_000
CELLS = 240_000
#: Bits of a symbol and of a token in a packed key.
SYMBOL, TOKEN = 10, 20

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Automaton:
    """The compiled merges.  States and arc labels are token ids; -1 is the start."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.suffix, self.label = suffix, {i: t for t, i in vocab.items()}
        n = max(vocab.values()) + 1
        self.first, self.last, self.time = [-1] * n, [-1] * n, [0] * n  # of the gadget that made a label
        self.cut: dict[int, int] = {}  # state << 20 | label -> time
        self.dead = {vocab[u + v] for u, v in merges}  # labels that no gadget has made (yet)
        for rank, (u, v) in enumerate(merges, 1):  # a gadget copies at 2 x rank, then cuts, then extends at 2 x rank + 1
            self._gadget(vocab[u], vocab[v], vocab[u + v], 2 * rank)
        self.symbols: dict[str, int] = {}
        self.next: dict[int, int] = {}  # trie: node << SYMBOL | symbol -> node
        self.ends, self.width = [-1], [0] * n  # node -> token; token -> its number of symbols
        for token, i in vocab.items():
            if i in self.dead:
                continue
            spelt, node = self.spell(token), 0
            self.width[i] = len(spelt)
            for symbol in spelt:
                key = node << SYMBOL | self.symbols.setdefault(symbol, len(self.symbols))
                node = self.next.setdefault(key, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = i
        self._forget()

    def _forget(self) -> None:
        self.under_way: list[tuple[int, ...]] = [(0,)]  # configuration -> its arcs: state + 1 << TOKEN | trie node
        self.number: dict[tuple, int] = {self.under_way[0]: 0}
        self.table: dict[int, int] = {}  # configuration << SYMBOL | symbol -> configuration << TOKEN | token

    def spell(self, token: str) -> list[str]:
        """The base symbols of a token; the word's end belongs to the last."""
        end = token.endswith(self.suffix) and len(token) > len(self.suffix)
        body = token[: -len(self.suffix)] if end else token
        return [*body[:-1], body[-1] + self.suffix if end else body[-1]]

    def _gadget(self, u: int, v: int, w: int, when: int) -> None:
        if w in self.dead and not {u, v} & self.dead and self.alive(u, v, when):  # an arc that is gone can't be merged
            self.dead.remove(w)
            self.cut[u << 20 | v] = when
            self.first[w], self.last[w], self.time[w] = u, v, when

    def alive(self, state: int, label: int, when: int) -> bool:
        """Whether the state has the arc just before the moment ``when``."""
        cut, time, first, last = self.cut, self.time, self.first, self.last
        while True:
            gone = cut.get(state << 20 | label)
            if gone is not None and gone < when:
                return False
            a, b = time[state], time[label]
            if a == 0 and b == 0:
                return True
            if a > b:  # the state is the younger: it was copied from the one after its last part
                state, when = last[state], a
            else:  # the arc is the younger: it extends the arc of its first part
                label, when = first[label], b + 1

    def _expand(self, here: int, symbol: int) -> int:
        """The cell of a configuration and a symbol."""
        going, done = [], None
        for arc in self.under_way[here]:
            state, node = (arc >> TOKEN) - 1, self.next.get((arc & (1 << TOKEN) - 1) << SYMBOL | symbol)
            if node is None:
                continue
            token = self.ends[node]
            if token >= 0 and (state < 0 or self.alive(state, token, 1 << 60)):
                done = token
            going.append(arc >> TOKEN << TOKEN | node)
        if done is None:
            raise ValueError("no arc ends here: a base symbol is missing from the vocabulary")
        to = (*going, done + 1 << TOKEN)
        number = self.number.setdefault(to, len(self.under_way))
        if number == len(self.under_way):
            self.under_way.append(to)
        cell = self.table[here << SYMBOL | symbol] = number << TOKEN | done
        return cell

    def encode(self, symbols: list[int]) -> list[int]:
        """The labels on the word's only accepting path."""
        if len(self.table) >= CELLS:
            self._forget()
        here, ended, find, mask = 0, [], self.table.get, (1 << TOKEN) - 1
        for symbol in symbols:
            cell = find(here << SYMBOL | symbol)
            if cell is None:
                cell = self._expand(here, symbol)
            ended.append(cell & mask)
            here = cell >> TOKEN
        out, at = [], len(ended)
        while at:
            out.append(ended[at - 1])
            at -= self.width[out[-1]]
        return out[::-1]

    def decode(self, ids: list[int]) -> list[str]:
        return [self.label[i] for i in ids]


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte, as byte-level vocabularies spell it."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def _classes(limit: int = 0x250) -> tuple[str, str, str]:
    """Letters, numbers and white space below ``limit`` as character class bodies."""
    out = {"L": "", "N": "", "Z": ""}
    for c in map(chr, range(limit)):
        kind = "Z" if c in "\t\n\v\f\r\x85" else unicodedata.category(c)[0]
        if kind in out:
            out[kind] += re.escape(c)
    return out["L"], out["N"], out["Z"]


class Tokenizer:
    """Splitting, normalising and the automaton of one vocabulary file."""

    def __init__(self, path: str) -> None:
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.automaton = Automaton(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]], model["end_of_word_suffix"])
        self.automaton.label.update({i: t for t, i in self.specials.items()})
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        self.inner, self.last = ([self.automaton.symbols[b + end] for b in byte_symbols()] for end in ("", self.automaton.suffix))
        self.number = {b: i for i, b in enumerate(byte_symbols())}
        self.bare = json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}})
        letters, numbers, white = _classes()
        contractions = "'(?:s|t|re|ve|m|ll|d)"
        self.ascii = re.compile(f"[a-z]+|{contractions}|[0-9]|[^{white}a-z0-9]+").findall
        self.latin = re.compile(f"[{letters}]+|{contractions}|[{numbers}]|[^{white}{letters}{numbers}]+").findall
        self.simple = re.compile("[\x00-\u024f]*").fullmatch
        self.pieces = re.compile(r"[^\t-\r ]+").findall
        self.ids: dict[str, str] = _Words(self, 0)
        self.decoded: dict[str, str] = _Words(self, 1)

    @cached_property
    def library(self):  # noqa: ANN201
        """The library's normaliser and splitter, without its model; loaded when a text needs it."""
        import tokenizers

        bare = tokenizers.Tokenizer.from_str(self.bare)
        return bare.normalizer.normalize_str, bare.pre_tokenizer.pre_tokenize_str

    def _split(self, part: str) -> list[str]:
        low = part.lower()
        if low.isascii():
            return self.ascii(low)
        if self.simple(low):
            return self.latin(low)
        out: list[str] = []
        for piece in self.pieces(part):
            low = piece.lower()
            if self.simple(low):
                out += self.latin(low)
            else:
                piece = piece.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
                normal, split = self.library
                out += [bytes(map(self.number.__getitem__, w)).decode() for w, _ in split(normal(piece))]
        return out

    def words(self, text: str) -> list[str]:
        """The pre-split words; a special token stays whole."""
        if "<|" not in text:
            return self._split(text)
        return [w for part in self.special.split(text) for w in ((part,) if part in self.specials else self._split(part))]

    def word(self, word: str) -> list[int]:
        if word in self.specials:
            return [self.specials[word]]
        inner, data = self.inner, word.encode()
        symbols = [inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        return self.automaton.encode(symbols)

    def encode(self, text: str) -> list[int]:
        return [i for word in self.words(text) for i in self.word(word)]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.automaton.decode(ids))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        words = self.words(text) if text else []
        ids = " ".join(map(self.ids.__getitem__, words))
        decoded = " ".join(map(self.decoded.__getitem__, words))
        return ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()


class _Words(dict):
    """Word -> its ids as text, or its decoded text; forgets all when full."""

    def __init__(self, owner: Tokenizer, kind: int) -> None:
        self.owner, self.kind = owner, kind

    def __missing__(self, word: str) -> str:
        o = self.owner
        ids = o.word(word)
        texts = " ".join(map(str, ids)), o.decode(ids)
        if len(word) <= 64:
            if len(o.ids) >= MEMORY:
                o.ids.clear()
                o.decoded.clear()
            dict.__setitem__(o.ids, word, texts[0])
            dict.__setitem__(o.decoded, word, texts[1])
        return texts[self.kind]


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


def forget() -> None:
    """Drop the tables; loading them again takes a fraction of a second a task, and idle workers stay small."""
    load.cache_clear()


def encode(docs: DataFrame, text: str = "text", path: str | None = None, ids: str = "token_ids", n: str = "n_tokens") -> DataFrame:
    """All columns of ``docs`` with the token ids (array<int>) and their number."""
    from pyspark.sql import functions as F

    where = path or tokenizer_path()

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        t = load(where)
        return texts.map(lambda s: t.encode(s) if s else [])

    return docs.withColumn(ids, run(F.col(text))).withColumn(n, F.size(ids).cast("long"))


def decode(tokens: DataFrame, ids: str = "token_ids", to: str = "decoded", path: str | None = None) -> DataFrame:
    """The inverse of `encode`: the arc labels of each id list, joined by one space."""
    from pyspark.sql import functions as F

    where = path or tokenizer_path()

    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        t = load(where)
        return lists.map(lambda x: t.decode(list(x)) if x is not None else "")

    return tokens.withColumn(to, run(F.col(ids)))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text; one pass, no shuffle."""
    where = path or tokenizer_path()

    def run(doc_ids: list, texts: list) -> list:
        t = load(where)
        return [doc_ids, *map(list, zip(*map(t.digest, texts), strict=True))]

    return by_batch(docs, SCHEMA, run, "doc_id", "text", done=forget)
