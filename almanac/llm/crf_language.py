"""Language of texts by a linear-chain conditional random field over words.

A word's features are its letter trigrams, its affixes of three letters and, for words that are
frequent in the learning sample, the word itself. Learned transitions tie the labels of
neighbouring words, so a word that two languages share follows its surroundings and a text that
switches language is labelled stretch by stretch. Forward-backward gives each word a
distribution over the languages; sentences are chains of their own. A text's language has
the largest sum over its words, where the opening counts extra by a weight that the sample
sets.

The field is learned with numpy on a bounded sample of labelled texts (`PER_LANGUAGE`, `MOST_CHARS`); each word of
a text is taught with the language of the text. Labelling runs inside the row of each text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import crc32_mod, mixed, quoted, table, without

HELD_OUT, HELD_OUT_REST = 3, 1
# Texts per language from which the field is learned, and the characters taken of each: of a longer text
# a stretch whose place follows from its hash.
PER_LANGUAGE = 400
MOST_CHARS = 20_000
BITS = 17
LEAST_IN_LEXICON = 30
EPOCHS = 3
RATE = 0.3
OPENING_WORDS = 12
OPENINGS = (0.0, 0.1, 0.25, 0.5, 1.0)
GROUP_CHARS = 1_000_000
UNKNOWN = "und"
OUTPUTS = ("lang_pred", "score", "runs")

_U = np.uint64
_SIZE = 1 << BITS


def _letter_codes() -> np.ndarray:
    """0 for what is no letter, else a number per lower-case letter below U+0800, per block above."""
    out = np.zeros(0x10000, np.uint64)
    for point in range(0x10000):
        c = chr(point)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[point] = low if low < 0x800 else 0x800 + (low >> 6)
    return out


_CODES = _letter_codes()
_BREAKS = np.zeros(0x10000, bool)
_BREAKS[[ord(c) for c in "\n.!?"]] = True


@dataclass
class Words:
    """The words of some texts: their letters' features, and where words, sentences and texts begin."""

    letters: np.ndarray  # trigram number of each letter
    starts: np.ndarray  # first letter of each word
    affixes: np.ndarray  # (words, 2) numbers of the first and last three letters
    hashes: np.ndarray
    chains: np.ndarray  # first word of each sentence
    text: np.ndarray  # text of each word


def read_words(texts: list[str]) -> Words:
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    basic = np.minimum(points, 0xFFFF).astype(np.uint16)
    codes = np.where(points > 0xFFFF, 0, _CODES[basic])
    above = np.flatnonzero(points > 0xFFFF)
    if above.size:
        kinds, which = np.unique(points[above], return_inverse=True)
        block = [0x800 + (int(p) >> 6) if chr(p).isalpha() else 0 for p in kinds]
        codes[above] = np.array(block, codes.dtype)[which]
    ends_of_text = np.cumsum([len(t) + 1 for t in texts])
    is_letter = codes != 0
    at = np.flatnonzero(is_letter)
    if not at.size:
        none = np.zeros(0, np.int64)
        return Words(none, none, none.reshape(0, 2), none.astype(np.uint64), none, none)
    padded = np.concatenate([np.zeros(3, np.uint64), codes, np.zeros(3, np.uint64)])
    before, here, after = padded[at + 2], padded[at + 3], padded[at + 4]
    gram = mixed((before * _U(0x1003F) + here) * _U(0x3A5B1) + after + _U(1))
    first = before == 0
    last = after == 0
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) - starts + 1
    begin = at[starts]
    end = begin + lengths - 1
    pick = lambda place, ok: np.where(ok, padded[place + 3], 0)
    two, three = lengths > 1, lengths > 2
    head = (pick(begin, True) * _U(0x1003F) + pick(begin + 1, two)) * _U(0x3A5B1) + pick(begin + 2, three)
    tail = (pick(end, True) * _U(0x1003F) + pick(end - 1, two)) * _U(0x3A5B1) + pick(end - 2, three)
    affixes = np.stack([mixed(head + _U(0x51ED270B)), mixed(tail + _U(0x7F4A7C15F39C))], axis=1)
    place = (np.arange(len(at)) - np.repeat(starts, lengths)).astype(np.uint64)
    hashes = mixed(np.add.reduceat(mixed(here * _U(0x9E3779B97F4A7C15) + place), starts))
    breaks = np.cumsum(_BREAKS[basic] & (points <= 0xFFFF))[begin]
    chains = np.flatnonzero(np.concatenate([[True], breaks[1:] != breaks[:-1]]))
    text = np.searchsorted(ends_of_text, begin, side="right")
    mask = _U(_SIZE - 1)
    return Words(
        (gram & mask).astype(np.int64), starts, (affixes & mask).astype(np.int64) + _SIZE, hashes, chains, text
    )


@dataclass
class Field:
    """Weights: rows of trigrams, then affixes, then lexicon words; transitions between languages."""

    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray  # sorted hashes
    moves: np.ndarray
    opening: float = 0.0

    def lexicon_rows(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The words that are in the lexicon, and their rows."""
        if not len(self.lexicon):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.lexicon, words.hashes), len(self.lexicon) - 1)
        known = np.flatnonzero(self.lexicon[place] == words.hashes)
        return known, place[known] + 2 * _SIZE

    def scores(self, words: Words) -> np.ndarray:
        out = np.add.reduceat(self.weights[words.letters], words.starts, axis=0)
        out += self.weights[words.affixes[:, 0]] + self.weights[words.affixes[:, 1]]
        known, rows = self.lexicon_rows(words)
        out[known] += self.weights[rows]
        return out


def forward_backward(
    scores: np.ndarray, chains: np.ndarray, moves: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of every word, and what pair marginals need: forward, local and backward values."""
    n, k = scores.shape
    lengths = np.diff(np.append(chains, n))
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = chains[order], lengths[order]
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) + 1e-12
    step = np.exp(moves)
    ahead, behind = np.empty((n, k)), np.ones((n, k))
    first = local[starts]
    ahead[starts] = first / first.sum(axis=1, keepdims=True)
    longest = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(longest + 1), side="left")  # chains longer than t
    for t in range(1, longest):
        at = starts[: active[t]] + t
        value = (ahead[at - 1] @ step) * local[at]
        ahead[at] = value / value.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        value = (local[at + 1] * behind[at + 1]) @ step.T
        behind[at] = value / value.sum(axis=1, keepdims=True)
    both = ahead * behind
    return both / both.sum(axis=1, keepdims=True), ahead, local, behind


def _gradient_step(field: Field, past: list[np.ndarray], words: Words, labels: np.ndarray) -> None:
    """One AdaGrad step on the likelihood of the labels of these words."""
    k = len(field.languages)
    marginals, ahead, local, behind = forward_backward(field.scores(words), words.chains, field.moves)
    error = marginals.copy()
    error[np.arange(len(labels)), labels] -= 1.0
    rows = np.concatenate([words.letters, words.affixes[:, 0], words.affixes[:, 1]])
    lengths = np.diff(np.append(words.starts, len(words.letters)))
    owner = np.concatenate([np.repeat(np.arange(len(labels)), lengths), np.tile(np.arange(len(labels)), 2)])
    known, lex = field.lexicon_rows(words)
    rows, owner = np.concatenate([rows, lex]), np.concatenate([owner, known])
    size = len(field.weights)
    grad = np.stack([np.bincount(rows, error[owner, j], minlength=size) for j in range(k)], axis=1)
    inner = np.ones(len(labels), bool)
    inner[words.chains] = False
    to = np.flatnonzero(inner)
    step = np.exp(field.moves)
    joint = ahead[to - 1][:, :, None] * step[None] * (local[to] * behind[to])[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    seen = np.zeros((k, k))
    np.add.at(seen, (labels[to - 1], labels[to]), 1.0)
    moves = joint.sum(axis=0) - seen
    for value, g, total in ((field.weights, grad, past[0]), (field.moves, moves, past[1])):
        total += g * g
        value -= (RATE * g / np.sqrt(total + 1e-6)).astype(value.dtype)
    np.clip(field.moves, -5.0, 5.0, out=field.moves)


def learn(texts: list[str], languages: list[str], epochs: int = EPOCHS) -> Field:
    """The field for labelled texts, in a fixed order of steps."""
    names = sorted(set(languages))
    number = {name: i for i, name in enumerate(names)}
    order = np.argsort(mixed(np.arange(1, len(texts) + 1, dtype=np.uint64)))
    batches, batch, size = [], [], 0
    for i in order:
        batch.append(int(i))
        size += len(texts[i])
        if size > 150_000:
            batches.append(batch)
            batch, size = [], 0
    batches += [batch] if batch else []
    parts = []
    for batch in batches:
        words = read_words([texts[i] for i in batch])
        if len(words.starts):
            parts.append((words, np.array([number[languages[i]] for i in batch])[words.text]))
    every = np.concatenate([w.hashes for w, _ in parts]) if parts else np.zeros(0, np.uint64)
    values, counts = np.unique(every, return_counts=True)
    least = max(3, min(LEAST_IN_LEXICON, len(every) // 5000))
    lexicon = values[counts >= least]
    k = len(names)
    field = Field(names, np.zeros((2 * _SIZE + len(lexicon), k), np.float32), lexicon, np.zeros((k, k)))
    past = [np.zeros(field.weights.shape, np.float32), np.zeros((k, k))]
    for _ in range(epochs if k > 1 else 0):
        for words, labels in parts:
            _gradient_step(field, past, words, labels)
    field.opening = _best_opening(field, texts, languages)
    return field


def _best_opening(field: Field, texts: list[str], languages: list[str]) -> float:
    """The weight of the opening that gets most of the sample right, the least of equals."""
    right = dict.fromkeys(OPENINGS, 0)
    truth = np.array([field.languages.index(x) for x in languages])
    for group in _groups(texts):
        share, opening, counts = _by_text(field, [texts[i] for i in group])
        for weight in OPENINGS:
            best = (share + weight * opening).argmax(axis=1)
            right[weight] += int(((best == truth[group]) & (counts > 0)).sum())
    return max(OPENINGS, key=lambda w: (right[w], -w))


def _groups(texts: list[str]) -> Iterator[list[int]]:
    group, size = [], 0
    for i, text in enumerate(texts):
        if group and size + len(text) > GROUP_CHARS:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(text)
    if group:
        yield group


def _by_text(field: Field, texts: list[str], labelled: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: mean marginals of all words, of the opening words, and the number of words."""
    words = read_words(texts)
    n, k = len(texts), len(field.languages)
    if not len(words.starts):
        return np.zeros((n, k)), np.zeros((n, k)), np.zeros(n, np.int64)
    marginals = forward_backward(field.scores(words), words.chains, field.moves)[0]
    if labelled is not None:
        labelled.append((words.text, marginals.argmax(axis=1)))
    counts = np.bincount(words.text, minlength=n)
    firsts = np.cumsum(counts) - counts
    early = np.arange(len(words.text)) - firsts[words.text] < OPENING_WORDS
    total = lambda m, t: np.stack([np.bincount(t, m[:, j], minlength=n) for j in range(k)], axis=1)
    share = total(marginals, words.text) / np.maximum(counts, 1)[:, None]
    opening = total(marginals[early], words.text[early]) / np.clip(counts, 1, OPENING_WORDS)[:, None]
    return share, opening, counts


def _runs(text: np.ndarray, label: np.ndarray, n: int, names: list[str]) -> list[list[dict]]:
    """Stretches of words with one label: first word, number of words, language."""
    out: list[list[dict]] = [[] for _ in range(n)]
    if len(text):
        new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (label[1:] != label[:-1])]))
        begins = {}
        for a, b in zip(new, np.append(new[1:], len(text))):
            t = int(text[a])
            begins.setdefault(t, int(a))
            out[t].append({"first": int(a) - begins[t], "words": int(b - a), "lang": names[label[a]]})
    return out


_RUN = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))


def _predicted(field: Field, with_runs: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_lang_text")
            others = [i for i in range(batch.num_columns) if i != at]
            texts = [t or "" for t in batch.column(at).to_pylist()]
            names, scores, runs = [], [], []
            for group in _groups(texts):
                own = [texts[i] for i in group]
                labelled: list | None = [] if with_runs else None
                if not field.languages:
                    names += [UNKNOWN] * len(own)
                    scores += [0.0] * len(own)
                    runs += [[]] * len(own)
                    continue
                share, opening, counts = _by_text(field, own, labelled)
                value = (share + field.opening * opening) / (1.0 + field.opening)
                best = value.argmax(axis=1)
                names += [field.languages[b] if c else UNKNOWN for b, c in zip(best, counts)]
                scores += [min(1.0, float(value[i, b])) if c else 0.0 for i, (b, c) in enumerate(zip(best, counts))]
                runs += _runs(*labelled[0], len(own), field.languages) if labelled else [[]] * len(own)
            made = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            made += [pa.array(runs, _RUN)] if with_runs else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in others), *made],
                [*(batch.schema.names[i] for i in others), *OUTPUTS[: len(made)]],
            )

    return run


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, most_chars: int = MOST_CHARS) -> Field:
    """Learn from labelled texts whose id is not held out; the sample on the driver is bounded."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.where(crc32_mod(F.col("doc_id"), HELD_OUT) != HELD_OUT_REST)
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_003))
    shares = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 1.2 * per_language / n))])
    rows = []
    if sizes:
        # the draw bounds what is sorted; the first of each language by hash are taken
        h = F.xxhash64("text")
        place = F.pmod(h, F.greatest(F.length("text") - most_chars, F.lit(0)) + 1).cast("int")
        part = F.substring("text", place + 1, F.lit(most_chars)).alias("text")
        drawn = known.where(draw < shares[F.col("lang")] * 1_000_003).select("lang", part, h.alias("h"))
        first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
        rows = drawn.withColumn("r", first).where(F.col("r") <= per_language).orderBy("lang", "r").collect()
    return learn([r["text"] for r in rows], [r["lang"] for r in rows])


def predict_languages(
    docs: DataFrame, field: Field | None = None, keep_text: bool = True, with_runs: bool = True
) -> DataFrame:
    """`docs` with lang_pred, score and, if wanted, the stretches of one language each.

    A null text, or one without a letter, is `und` with score 0, and so is every text when
    nothing can be learned. Repeated rows are labelled one by one, an empty table gives an empty table,
    columns with the names of the outputs are replaced.
    """
    field = train(docs) if field is None else field
    kept = without(docs, *OUTPUTS, "_lang_text")
    kept = kept if keep_text else without(kept, "text")
    given = docs.select(*[quoted(c) for c in kept.columns], F.col("text").cast("string").alias("_lang_text"))
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    fields += ["lang_pred string", "score double"]
    fields += ["runs array<struct<first:bigint,words:bigint,lang:string>>"] if with_runs else []
    return given.mapInArrow(_predicted(field, with_runs), ", ".join(fields))


def op4_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict_languages(docs, keep_text=False, with_runs=False)
    held_out = crc32_mod(F.col("doc_id"), HELD_OUT) == HELD_OUT_REST
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_crf_language": op4_crf_language}
ORACLE: dict[str, str] = {}
