"""Token counts by a tokenizer compiled to a finite-state transducer."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from string import ascii_letters

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 15
ONE_BYTE_LETTERS = frozenset(ascii_letters)
KEPT_STATES = 400_000
KEPT_WORDS = 400_000
LONG_WORD = 40
MARK = "\ud800"
START, LETTERS, OTHERS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(7)
SPACE, NUMBER = "space", "number"
# White space of the tokenizer's pattern besides the blank.
OTHER_WHITE = regex.compile("[\t\n\v\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
OPEN = {QUOTE: "", QUOTE_R: "r", QUOTE_V: "v", QUOTE_L: "l"}
# The endings the tokenizer's pattern takes together with an apostrophe.
ENDINGS = {"s", "t", "re", "ve", "m", "ll", "d"}
LETTER, DIGIT = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
# Lower case of letters newer than the Unicode tables of the Python here.
NEWER = {0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {c: c + 32 for c in range(0x10D50, 0x10D66)}
HAS_NEWER = regex.compile("[" + "".join(map(chr, NEWER)) + "]")


def read_rules(path: str) -> dict:
    """What the transducer needs of a tokenizer's file: vocabulary, merges, special strings.

    Only files with the rules this module compiles are taken: canonical composition,
    lower case, words with a marked end, byte-level merges.
    """
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    steps = [step["type"] for step in whole["normalizer"]["normalizers"]]
    if steps != ["NFC", "Replace", "Lowercase"] or whole["model"]["end_of_word_suffix"] != "</w>":
        raise ValueError("the file's tokenizer is not of the kind this transducer compiles")
    return {
        "vocab": whole["model"]["vocab"], "merges": whole["model"]["merges"],
        "special": [t["content"] for t in whole["added_tokens"] if t["special"]],
    }


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Which tokens may stand side by side in an encoding."""

    def __init__(self, rules: dict):
        vocab = rules["vocab"]
        letters = _byte_letters()
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.spelled: dict[int, tuple[bytes, bool]] = {}
        for letter, byte in letters.items():
            self.spelled[vocab[letter]] = (bytes([byte]), False)
            self.spelled[vocab[letter + "</w>"]] = (bytes([byte]), True)
        for pair in rules["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.joined[a, b] = whole
            self.halves[whole] = (a, b)
            self.spelled[whole] = (self.spelled[a][0] + self.spelled[b][0], self.spelled[b][1])
        self.single = {spelled: token for token, spelled in self.spelled.items() if token not in self.halves}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}

    def stands(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as this token; some are never reached."""
        known = self.whole.get(token)
        if known is None:
            data, closed = self.spelled[token]
            parts = [self.single[data[k:k + 1], closed and k == len(data) - 1] for k in range(len(data))]
            while True:
                best = min(((self.joined.get((a, b), 1 << 60), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
                if best[0] == 1 << 60:
                    break
                parts[best[1]:best[1] + 2] = [best[0]]
            known = self.whole[token] = parts == [token]
        return known

    def fits(self, before: int, token: int) -> bool:
        """Whether the two tokens follow each other (before -1: the piece begins).

        Merges are undone from the latest down; the border holds if no merge across
        it was due before one that was undone.
        """
        known = self.pairs.get((before, token))
        if known is None:
            known = self.stands(token) and (before < 0 or self._border(before, token))
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            self.pairs[before, token] = known
        return known

    def _border(self, a: int, b: int) -> bool:
        limit = 1 << 60
        while True:
            if self.joined.get((a, b), 1 << 60) < limit:
                return False
            x, y = self.halves.get(a), self.halves.get(b)
            if x is None and y is None:
                return True
            if y is None or (x is not None and a > b):
                limit, a = a, x[1]
            else:
                limit, b = b + 1, y[0]


class State(dict):
    """A state: for each character (next state, change of the token count)."""

    __slots__ = ("key", "machine", "ended")

    def __init__(self, machine: "Transducer", key: tuple):
        super().__init__()
        self.machine, self.key, self.ended = machine, key, None

    def end(self) -> int:
        """Change of the count when the text, or the word, ends here."""
        if self.ended is None:
            self.ended = self.machine.rest(*self.key)
        return self.ended

    def __missing__(self, ch: str):
        machine, (phase, held, active) = self.machine, self.key
        if phase == LETTERS and ch in ONE_BYTE_LETTERS:
            active, change = machine._advance(active, held, machine.plain)
            key = (phase, ord(ch), active)
        else:
            key, change = machine.transition(phase, held, active, ch)
        after = machine.states.get(key)
        if after is None:
            after = machine.states[key] = State(machine, key)
        found = self[ch] = (after, change)
        return found


class Words(dict):
    """Transitions of the first state over whole words: tokens between two blanks.

    White space leads every state back to the first, so a word's tokens are always
    the same, and a comma or full stop after letters begins a piece of its own. Long
    words are run each time.
    """

    def __init__(self, machine: "Transducer"):
        super().__init__()
        self.machine = machine

    def __missing__(self, word: str) -> int:
        if word[-1:] in (",", ".") and word[:-1].isalpha():
            count = self[word[:-1]] + self[word[-1]]
        else:
            state, count = self.machine.stepped(self.machine.state(self.machine.BEGIN), word)
            count += state.end()
        if len(word) <= LONG_WORD:
            self[word] = count
        return count


class Transducer:
    """A deterministic machine over characters whose transitions carry token counts.

    A state is (phase, held, active). The phase says how far the word pattern has
    got. `held` is the last byte read, which may turn out to be a piece's last and
    then has other tokens. `active` lists the places where a token may have begun:
    (node of the vocabulary's trie, token before, tokens since). Of all tokens that
    end at a byte exactly one goes with the one before it, so the count of every
    prefix is known as it is read, and a transition's count is the difference to
    the prefix before (it can be below zero when a longer token takes over). There
    are finitely many states; they are compiled when first reached and dropped
    together when there are very many.
    """

    BEGIN = (START, -1, ((0, -1, 0),))

    def __init__(self, rules: dict):
        self.merges = Merges(rules)
        self.special = sorted(rules["special"], key=len, reverse=True)
        self.child: list[dict[int, int]] = [{}]
        self.plain: list[int] = [-1]
        self.closing: list[int] = [-1]
        for token, (data, closed) in self.merges.spelled.items():
            node = 0
            for byte in data:
                if byte not in self.child[node]:
                    self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.plain.append(-1)
                    self.closing.append(-1)
                node = self.child[node][byte]
            (self.closing if closed else self.plain)[node] = token
        self.kinds: dict[str, object] = {}
        self.states: dict[tuple, State] = {}
        self.words = Words(self)

    def state(self, key: tuple) -> State:
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(self, key)
        return found

    def trim(self) -> None:
        if len(self.states) > KEPT_STATES:
            self.states.clear()
        if len(self.words) > KEPT_WORDS:
            self.words.clear()

    def kind(self, ch: str):
        known = self.kinds.get(ch)
        if known is None:
            known = SPACE if ch == " " else LETTERS if LETTER.match(ch) else NUMBER if DIGIT.match(ch) else OTHERS
            self.kinds[ch] = known
        return known

    def _advance(self, active: tuple, byte: int, tokens: list[int]) -> tuple[tuple, int]:
        """The places where tokens may have begun, and the change of the count, after a byte."""
        child, known, fits = self.child, self.merges.pairs.get, self.merges.fits
        grown, chosen, change = [], -1, 0
        for node, before, since in active:
            node = child[node].get(byte)
            if node is None:
                continue
            if child[node]:
                grown.append((node, before, since))
            if chosen < 0:
                token = tokens[node]
                if token >= 0:
                    fit = known((before, token))
                    if fit is None:
                        fit = fits(before, token)
                    if fit:
                        chosen, change = token, 1 - since
        if change:
            grown = [(node, before, since + change) for node, before, since in grown]
        return (*grown, (0, chosen, 0)), change

    def _feed(self, active: tuple, held: int, data: bytes) -> tuple[tuple, int, int]:
        total = 0
        for byte in (bytes([held]) if held >= 0 else b"") + data[:-1]:
            active, change = self._advance(active, byte, self.plain)
            total += change
        return active, data[-1], total

    def _end(self, active: tuple, held: int) -> int:
        return self._advance(active, held, self.closing)[1]

    def _piece(self, text: str) -> int:
        active, held, change = self._feed(self.BEGIN[2], -1, text.encode())
        return change + self._end(active, held)

    def transition(self, phase: int, held: int, active: tuple, ch: str) -> tuple[tuple, int]:
        if ch == MARK:
            return self.BEGIN, self.rest(phase, held, active) + 1
        kind = self.kind(ch)
        if phase >= QUOTE:
            tail = OPEN[phase] + ch
            if tail in ENDINGS:
                return self.BEGIN, self._piece("'" + tail)
            for opened, begun in OPEN.items():
                if begun == tail:
                    return (opened, held, active), 0
            if phase != QUOTE:
                key, change = self.transition(LETTERS, ord(OPEN[phase]), self.BEGIN[2], ch)
                return key, self._end(active, held) + change
            phase = OTHERS
        if phase == kind:
            active, held, change = self._feed(active, held, ch.encode())
            return (phase, held, active), change
        ended = self.rest(phase, held, active)
        if kind == SPACE:
            return self.BEGIN, ended
        if kind == NUMBER:
            return self.BEGIN, ended + self._piece(ch)
        active, held, change = self._feed(self.BEGIN[2], -1, ch.encode())
        return (QUOTE if ch == "'" else kind, held, active), ended + change

    def rest(self, phase: int, held: int, active: tuple) -> int:
        """Change of the count when the text ends in this state."""
        if phase == START:
            return 0
        ended = self._end(active, held)
        return ended + (self._piece(OPEN[phase]) if phase > QUOTE else 0)

    def run(self, state: State, text: str) -> tuple[State, int]:
        """State and tokens after the text; whole words between blanks are one step each."""
        if " " not in text:
            return self.stepped(state, text)
        first, *words = text.split(" ")
        state, count = self.stepped(state, first)
        count += state.end()
        last = words.pop()
        count += sum(map(self.words.__getitem__, words))
        state, more = self.stepped(self.state(self.BEGIN), last)
        return state, count + more

    def stepped(self, state: State, text: str) -> tuple[State, int]:
        total = 0
        for ch in text:
            state, change = state[ch]
            total += change
        return state, total

    def normal(self, text: str) -> str:
        """The text as the machine reads it; special strings become one mark."""
        parts = [text]
        for special in self.special:
            parts = [piece for part in parts for piece in _between(part.split(special))]
        return "".join(p if p == MARK else _folded(unicodedata.normalize("NFC", p)) for p in parts)

    def count(self, text: str) -> int:
        self.trim()
        state, total = self.run(self.state(self.BEGIN), self.normal(text))
        return total + state.end()

    def chunk_map(self, text: str) -> tuple[str, int, tuple | None]:
        """What a chunk does to any state before it: (head, count, exit).

        The head is what must be read from the state before: up to a character after
        which the state is the same whatever came before (white space, a number, a
        special string, the first letter after a mark other than an apostrophe). The
        count is that of all after the head and `exit` the state after it; it is None
        where the chunk holds no such character.
        """
        self.trim()
        text = self.normal(text)
        before = None
        for at, ch in enumerate(text):
            kind = SPACE if ch == MARK else self.kind(ch)
            begun = self.BEGIN if kind in (SPACE, NUMBER) else None
            if kind == LETTERS and before == OTHERS and text[at - 1] != "'":
                begun = self.transition(*self.BEGIN, ch)[0]
            if begun:
                state, count = self.run(self.state(begun), text[at + 1:])
                return text[:at + 1], count, state.key
            before = kind
        return text, 0, None

    def composed(self, maps: list[tuple[str, int, tuple | None]]) -> tuple[str, int, tuple | None]:
        """The map of neighbouring chunks taken together, by halves; composition is associative."""
        if len(maps) == 1:
            return maps[0]
        half = len(maps) // 2
        head, count, exit_ = self.composed(maps[:half])
        next_head, next_count, next_exit = self.composed(maps[half:])
        if exit_ is None:
            return head + next_head, next_count, next_exit
        state, read = self.run(self.state(exit_), next_head)
        return head, count + read + next_count, next_exit or state.key

    def applied(self, whole: tuple[str, int, tuple | None]) -> int:
        """Tokens of a text from its map."""
        head, count, exit_ = whole
        state, read = self.run(self.state(self.BEGIN), head)
        return read + count + self.state(exit_ or state.key).end()


def _between(parts: list[str]) -> Iterator[str]:
    for k, part in enumerate(parts):
        if k:
            yield MARK
        if part:
            yield part


def _folded(text: str) -> str:
    """Blanks for white space, and lower case letter by letter: a sigma at a word's end is no exception."""
    text = OTHER_WHITE.sub(" ", text)
    if not text.isascii() and HAS_NEWER.search(text):
        text = text.translate(NEWER)
    return text.replace("Σ", "σ").lower()


def cuts(text: str, size: int, special: list[str]) -> list[str]:
    """The text in chunks of about `size` characters.

    A cut lies only before a character that no composition joins to the one before,
    and never within a special string; a chunk grows until there is such a place.
    """
    out, begin = [], 0
    while len(text) - begin > size:
        at = begin + size
        while at < len(text):
            if unicodedata.category(text[at])[0] == "M" or "\u1100" <= text[at] <= "\u11ff":
                at += 1
                continue
            spanning = (text.find(s, max(begin, at - len(s) + 1), at + len(s) - 1) + len(s) for s in special)
            end = max((e for s, e in zip(special, spanning) if e >= len(s)), default=at)
            if end == at:
                break
            at = end
        out.append(text[begin:at])
        begin = at
    return [*out, text[begin:]]


_machines: dict[str, Transducer] = {}


def _machine(name: str, rules: dict) -> Transducer:
    if name not in _machines:
        _machines.clear()
        _machines[name] = Transducer(rules)
    return _machines[name]


COUNTS = "doc_id long, n_bytes long, n_tokens long"


def count_tokens(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, chunk: int = CHUNK,
) -> DataFrame:
    """Rows doc_id, n_bytes, n_tokens: UTF-8 bytes and tokens of each whole text.

    Without begin and end tokens; special strings within a text count as one token
    each, as the tokenizer's library has it. A null text counts as empty and has no
    tokens; rows are independent, so repeated rows repeat; other columns are not
    read; an empty table gives no rows. The vocabulary, a file of fixed size, is
    broadcast.

    A text of up to `chunk` characters is read by the machine where it is. A longer
    one is cut into chunks that are dealt over all tasks; each gives its map from
    the state before to the state after, and the maps of a text, a few numbers and a
    short head each, are composed in order. No other text moves.
    """
    rules = df.sparkSession.sparkContext.broadcast(read_rules(path or public_tokenizers.path("word_bpe_49k.json")))
    name = path or ""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = "row"
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    long = F.length("text") > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(name, rules.value)
        for batch in batches:
            counts = [machine.count(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = rules.value["special"]
        for batch in batches:
            for k in range(batch.num_rows):
                parts = cuts(batch.column(3)[k].as_py(), chunk, special)
                same = [batch.column(c).slice(k, 1).take(pa.array([0] * len(parts))) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(range(len(parts)), pa.int32()), pa.array(parts)], ["doc_id", "n_bytes", "row", "chunk", "text"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(name, rules.value)
        for batch in batches:
            maps = [machine.chunk_map(t.as_py()) for t in batch.column(4)]
            exits = [None if e is None else [e[0], e[1], *(n for place in e[2] for n in place)] for _, _, e in maps]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([m[0].encode("utf-8", "surrogatepass") for m in maps], pa.binary()), pa.array([m[1] for m in maps], pa.int64()), pa.array(exits, pa.list_(pa.int32()))],
                ["doc_id", "n_bytes", "row", "chunk", "head", "count", "exit"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(name, rules.value)
        for batch in batches:
            counts = []
            for maps in batch.column(2):
                parts = [(m["head"].decode("utf-8", "surrogatepass"), m["count"], _key(m["exit"])) for m in maps.as_py()]
                counts.append(machine.applied(machine.composed(parts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    short = rows.where(~long).mapInArrow(whole, COUNTS)
    numbered = rows.where(long).select("doc_id", "n_bytes", F.monotonically_increasing_id().alias("row"), "text")
    ids = "doc_id long, n_bytes long, row long, chunk int"
    chunks = numbered.mapInArrow(cut, f"{ids}, text string").repartition("row", "chunk")
    maps = chunks.mapInArrow(mapped, f"{ids}, head binary, count long, exit array<int>")
    each = maps.groupBy("row", "doc_id", "n_bytes").agg(F.sort_array(F.collect_list(F.struct("chunk", "head", "count", "exit"))).alias("maps"))
    return short.unionByName(each.select("doc_id", "n_bytes", "maps").mapInArrow(joined, COUNTS))


def _key(numbers: list[int] | None) -> tuple | None:
    if numbers is None:
        return None
    places = iter(numbers[2:])
    return numbers[0], numbers[1], tuple(zip(places, places, places))
