"""Secret scans: base patterns, and formats learned by merging states of a prefix tree.

Labelled credentials become a prefix tree of characters whose states are merged when their continuations
are statistically compatible (Hoeffding bound); the result is a probabilistic automaton per kind.  Every
long token of every text is then scored by its likelihood under the automata against that under the
automata of ordinary tokens: words, and tokens with digits that have the shape of numbers, dates, versions,
host names or numbered names.  Times and UUIDs are ordinary in any corpus.  Only texts go to Python, only spans come back; nothing is shuffled.

NULL and empty texts have no spans; repeated rows each get a result; without labelled credentials
only base spans are found.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, deque
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from taxaflow.llm.common import as_text, lean, lean_stage, stored, text_or_empty

# The base patterns.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
BASE_KINDS = ("assign", "access", "hex")

LEAST = 12  # characters of the shortest candidate, as of the shortest assigned credential
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")  # candidates of the learned formats
LABELLED_ROWS = 2_000  # most credentials, and most ordinary tokens of either sort, that a model is fitted on
DEPTH = 40  # characters after which a token stays in its last state of the prefix tree, the same for all tokens
ALPHA = 0.05  # level of the compatibility test
ACCEPT = 1.5  # nats per character by which a format must beat the background
SHRINK = 5.0  # weight, in characters, of a state's share of a symbol against its own count of a character
CACHE = 50_000  # tokens whose score a task remembers

# Ordinary tokens with digits: letters, then digits, between separators.
NUMBERED = re.compile(r"[+/_.=-]*+[A-Za-z]*+[0-9]*+(?:[+/_.=-]++[A-Za-z]*+[0-9]*+)*+")
WORD, NUMBER = "", "number"  # the two sorts of ordinary tokens
UUID_SHAPE = "x" * 8 + ("-" + "x" * 4) * 3 + "-" + "x" * 12


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """assign, access and hex spans of one text, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def symbol(char: str) -> str:
    """The class of a character: digits, a-f, other lower case, upper case, the rest as they are."""
    if "0" <= char <= "9":
        return "0"
    if "a" <= char <= "f":
        return "a"
    if "g" <= char <= "z":
        return "z"
    return "A" if "A" <= char <= "Z" else char


# How many characters share the probability of a symbol.
SHARE = {"0": 10, "a": 6, "z": 20, "A": 26}


def by_symbol(counts: Counter) -> Counter:
    out: Counter = Counter()
    for char, n in counts.items():
        out[symbol(char)] += n
    return out


class Automaton:
    """A probabilistic automaton over characters: ``counts[state]`` is {character: count, "": ends}.

    A state's count of a character is smoothed by its share of the character's symbol.  A character that a state
    has never seen moves as the commonest one of its symbol does there, or stays.
    """

    def __init__(self, counts: list[Counter], moves: list[dict[str, int]]) -> None:
        self.counts, self.moves = counts, moves
        self.totals = [sum(c.values()) for c in counts]
        self.symbols = [by_symbol(c) for c in counts]
        self.steps: list[dict[str, tuple[float, int]]] = [{} for _ in counts]

    def _step(self, state: int, char: str) -> tuple[float, int]:
        s, counts, total = symbol(char), self.counts[state], self.totals[state]
        share = (self.symbols[state][s] + 0.01) / (total + 0.7) / SHARE.get(s, 1)
        alike = [c for c in self.moves[state] if symbol(c) == s]
        best = char if char in self.moves[state] else max(alike, key=lambda c: (counts[c], c), default=None)
        found = self.steps[state][char] = math.log((counts[char] + SHRINK * share) / (total + SHRINK)), self.moves[state].get(best, state)
        return found

    def log_likelihood(self, token: str) -> float:
        state, total = 0, 0.0
        for char in token:
            cost, state = self.steps[state].get(char) or self._step(state, char)
            total += cost
        return total


def _prefix_tree(tokens: Iterable[str]) -> tuple[list[Counter], list[dict[str, int]]]:
    """Counts and moves of each state; characters after the first DEPTH are counted in the state reached there."""
    counts, moves = [Counter()], [{}]
    for token in tokens:
        state = 0
        for place, char in enumerate(token):
            counts[state][char] += 1
            if place >= DEPTH:
                moves[state][char] = state
                continue
            if char not in moves[state]:
                moves[state][char] = len(counts)
                counts.append(Counter())
                moves.append({})
            state = moves[state][char]
        counts[state][""] += 1
    return counts, moves


def _difference(a: Counter, b: Counter) -> float | None:
    """The largest difference of two states' shares, of characters or symbols; None if it is beyond the Hoeffding bound."""
    na, nb = sum(a.values()), sum(b.values())
    if not na or not nb:
        return 0.0
    bound, worst = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(na) + 1 / math.sqrt(nb)), 0.0
    for one, other in ((a, b), (by_symbol(a), by_symbol(b))):
        worst = max(worst, max(abs(one[s] / na - other[s] / nb) for s in {*one, *other}))
        if worst > bound:
            return None
    return worst


def infer(tokens: list[str]) -> Automaton:
    """Merge states of the prefix tree of ``tokens``, in breadth-first order, each with the closest compatible state."""
    counts, moves = _prefix_tree(tokens)
    parent = list(range(len(counts)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def distance(a: int, b: int) -> float | None:
        """How far two states and all that follows them lie apart; None if some pair is incompatible."""
        first, waiting, seen = None, [(a, b)], set()
        while waiting:
            a, b = (find(x) for x in waiting.pop())
            if a == b or (a, b) in seen:
                continue
            seen.add((a, b))
            apart = _difference(counts[a], counts[b])
            if apart is None:
                return None
            first = apart if first is None else first
            waiting += [(moves[a][s], moves[b][s]) for s in moves[a].keys() & moves[b].keys()]
        return first or 0.0

    def merge(a: int, b: int) -> None:
        waiting = [(a, b)]
        while waiting:
            a, b = (find(x) for x in waiting.pop())
            if a == b:
                continue
            parent[b] = a
            counts[a] += counts[b]
            for s, target in moves[b].items():
                if s in moves[a]:
                    waiting.append((moves[a][s], target))
                else:
                    moves[a][s] = target

    red = [0]
    queue = deque(moves[0][s] for s in sorted(moves[0]))
    while queue:
        blue = find(queue.popleft())
        own = dict.fromkeys(map(find, red))
        if blue in own:
            continue
        apart = [(d, place, r) for place, r in enumerate(own) if (d := distance(r, blue)) is not None]
        if not apart:
            red.append(blue)
            queue += [moves[blue][s] for s in sorted(moves[blue])]
        else:
            partner = min(apart)[2]
            merge(partner, blue)
            root = find(partner)
            queue += [moves[root][s] for s in sorted(moves[root]) if find(moves[root][s]) not in own]
    names = {s: i for i, s in enumerate(dict.fromkeys(find(x) for x in [0, *red]))}
    todo = list(names)
    while todo:
        for target in moves[todo.pop()].values():
            if (t := find(target)) not in names:
                names[t] = len(names)
                todo.append(t)
    order = sorted(names, key=names.get)
    return Automaton([counts[s] for s in order], [{k: names[find(t)] for k, t in moves[s].items()} for s in order])


def ordinary_sort(token: str) -> str | None:
    """WORD or NUMBER for a token that looks ordinary, else None."""
    if not any("0" <= c <= "9" for c in token):
        return WORD
    return NUMBER if NUMBERED.fullmatch(token) else None


def uuid_automaton() -> Automaton:
    """UUIDs, which a corpus need not hold: one state for each place."""
    hexadecimal = "0123456789abcdefABCDEF"
    counts = [Counter({"-": 1_000} if s == "-" else dict.fromkeys(hexadecimal, 50)) for s in UUID_SHAPE]
    return Automaton([*counts, Counter({"": 1_000})], [*(dict.fromkeys(c, i + 1) for i, c in enumerate(counts)), {}])


def times() -> list[str]:
    """Dates with hours, which a corpus need not hold."""
    return [f"{1970 + i}-{1 + i * 5 % 12:02}-{1 + i * 11 % 28:02}T{i * 7 % 24:02}" for i in range(80)]


class Formats:
    """Automata of credential formats, and of the sorts of ordinary tokens."""

    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str]) -> None:
        self.automata = {kind: infer(tokens) for kind, tokens in sorted(labelled.items()) if len(tokens) >= 5}
        sorts = {sort: [t for t in ordinary if ordinary_sort(t) == sort] for sort in (WORD, NUMBER)}
        sorts[NUMBER] += times()
        self.background = [uuid_automaton(), *(infer(tokens) for tokens in sorts.values() if tokens)]
        self.known: dict[str, float] = {}

    def score(self, token: str) -> float:
        """Nats per character by which the best format beats the best background."""
        if not self.automata:
            return -math.inf
        found = self.known.get(token)
        if found is None:
            best = max(a.log_likelihood(token) for a in self.automata.values())
            found = (best - max(a.log_likelihood(token) for a in self.background)) / len(token)
            if len(self.known) >= CACHE:
                self.known.clear()
            if len(token) <= 4 * DEPTH:
                self.known[token] = found
        return found


def all_spans(text: str, formats: Formats | None, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans and, where no base span lies, tokens that fit a learned format."""
    if formats is None:
        return base
    extra = []
    for m in TOKEN.finditer(text):
        for start, end in _outside(m.start(), m.end(), base):
            if formats.score(text[start:end]) >= ACCEPT:
                extra.append(("format", start, end))
                continue
            # A credential may stand between ordinary words with dots.
            for part in re.finditer(r"[^.]{%d,}" % LEAST, text[start:end]):
                if len(part[0]) < end - start and formats.score(part[0]) >= ACCEPT:
                    extra.append(("format", start + part.start(), start + part.end()))
    order = (*BASE_KINDS, "format")
    return sorted(base + extra, key=lambda s: (s[1], order.index(s[0])))


def _outside(start: int, end: int, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Stretches of LEAST characters or more that no base span covers."""
    for _, s, e in base:  # by start
        if s < end and start < e:
            if s - start >= LEAST:
                yield start, s
            start = max(start, e)
    if end - start >= LEAST:
        yield start, end


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scanner(formats: Formats | None):
    """A column function: text -> struct<n_assign, n_access, n_hex, base, spans>."""
    @pandas_udf("struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base:string,spans:string>")
    @lean
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            text = as_text(value)
            base = base_spans(text)
            kinds = Counter(k for k, _, _ in base)
            rows.append((*(kinds[k] for k in BASE_KINDS), _joined(base), _joined(all_spans(text, formats, base))))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    return scan


def labelled_tokens(text: str) -> Iterator[tuple[str, str]]:
    """(kind, token) of each base span, and ordinary long tokens outside base spans with their sort."""
    base = base_spans(text)
    for kind, start, end in base:
        yield kind, ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]
    for m in TOKEN.finditer(text):
        if not any(s < m.end() and m.start() < e for _, s, e in base) and (sort := ordinary_sort(m[0])) is not None:
            yield sort, m[0]


def _place(kind: str, token: str) -> int:
    return zlib.crc32(f"{kind} {token}".encode())


def _sampled(rows: int):
    """The ``rows`` tokens of each kind that come first by hash, within one task."""
    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[str, set[tuple[int, str]]] = {}
        for batch in batches:
            for value in batch["text"]:
                for kind, token in labelled_tokens(as_text(value)):
                    best.setdefault(kind, set()).add((_place(kind, token), token[:4 * DEPTH]))
            best = {kind: set(sorted(tokens)[:rows]) for kind, tokens in best.items()}
        for kind, tokens in best.items():
            yield pd.DataFrame([(kind, place, token) for place, token in tokens], columns=["kind", "place", "token"])

    return sample


def fit_formats(documents: DataFrame, rows: int = LABELLED_ROWS) -> Formats:
    """Fit on a bounded sample of labelled tokens: the ``rows`` distinct ones of each kind that come first by hash.

    Of each, the first 4 * DEPTH characters are learned from; texts are searched for whole tokens.
    """
    tokens = stored(documents.select("text").mapInPandas(lean_stage(_sampled(rows)), "kind string, place bigint, token string"), "credentials")
    by_kind = {}
    for kind in (WORD, NUMBER, *BASE_KINDS):
        sample = tokens.where(F.col("kind") == kind).select("place", "token").distinct().orderBy("place", "token").limit(rows)
        by_kind[kind] = [r["token"] for r in sample.collect()]
    return Formats({k: by_kind[k] for k in BASE_KINDS}, by_kind[WORD] + by_kind[NUMBER])


def find_secrets(df: DataFrame, formats: Formats | None, text: str = "text", into: str = "secrets") -> DataFrame:
    """Add ``into``: counts of base spans, base spans and all spans of each text."""
    return df.withColumn(into, scanner(formats)(text_or_empty(text)))


def secret_digest(documents: DataFrame, formats: Formats | None) -> DataFrame:
    found = find_secrets(documents.select("doc_id", "text"), formats).select("doc_id", F.col("secrets").alias("s"))
    return found.select("doc_id", "s.n_assign", "s.n_access", "s.n_hex", F.sha2(F.col("s.base"), 256).alias("base_sha256"), "s.spans")


def redacted_text(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with each span replaced by ``mark``; overlapping spans become one mark."""
    parts, at = [], 0
    for start, end in sorted((s, e) for _, s, e in spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


REDACTED_ROWS = 200


def redact_texts(df: DataFrame, formats: Formats | None, text: str = "text", into: str = "redacted", mark: str = "[secret]") -> DataFrame:
    """``df`` with every secret in ``text`` replaced, and ``into``: whether the row was changed.

    Texts are searched and replaced in one pass, a few rows at a time; all other columns go through untouched.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.BooleanType())])
    place, names = df.columns.index(text), [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, REDACTED_ROWS):
                part = batch.slice(begin, REDACTED_ROWS)
                texts, changed = part.column(place).to_pylist(), []
                for i, value in enumerate(texts):
                    spans = all_spans(value, formats, base_spans(value)) if value else []
                    changed.append(bool(spans))
                    if spans:
                        texts[i] = redacted_text(value, spans, mark)
                columns = list(part.columns)
                columns[place] = pa.array(texts, columns[place].type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(changed, pa.bool_())], names)

    return df.mapInArrow(lean_stage(run), schema)
