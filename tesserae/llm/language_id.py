"""Language identification of mixed-language texts.

The script of a word narrows its candidate languages (those that were learned with that script). Candidates score by
character n-grams. Viterbi over the words, with a penalty for each switch, labels spans; the text's language is that of
most of its letters.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import named, rest, sliced, spread

#: First code point of each script range (fixed values; letters outside belong to the range below).
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Latin"), (0x2DE0, "Cyrillic"), (0x2E80, "Han"), (0x3040, "Hiragana"), (0x30A0, "Katakana"),
    (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Katakana"), (0x3400, "Han"), (0xA000, "Yi"),
    (0xA640, "Cyrillic"), (0xA720, "Latin"), (0xAC00, "Hangul"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Katakana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"),
]
_STARTS = [x for x, _ in SCRIPTS]
#: A word's score for a language lies from -CAP to 0 (its best language).
CAP = 8.0
UNKNOWN = "und"
_BLANK = re.compile(r"\s")


def script_of(letter: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(letter)) - 1][1]


def letters_of(token: str) -> str:
    return token.lower() if token.isalpha() else "".join([c for c in token.lower() if c.isalpha()])


def main_script(word: str) -> str:
    """The script of most letters of a word."""
    if word.isascii():
        return "Latin"
    scripts = Counter(map(script_of, word))
    return max(scripts, key=lambda s: (scripts[s], s))


def grams_of(word: str) -> list[str]:
    """Character triples of a word with its borders marked."""
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


def words_in_parts(text: str, size: int = 1 << 20):
    """The words of a text, as lists of those of about ``size`` characters: a very long text is never one list of words."""
    begin = 0
    while begin < len(text):
        blank = _BLANK.search(text, begin + size) if begin + size < len(text) else None
        end = blank.start() if blank else len(text)
        yield text[begin:end].split()
        begin = end


class Model:
    """Log-probabilities of n-grams by language, and the scripts of each language.

    A gram is held with the languages that have it only; its weight there is over that of a gram which the language lacks.
    """

    def __init__(self, grams: list[tuple[str, str, int]], scripts: list[tuple[str, str, int]], documents: dict[str, int]):
        """``grams`` and ``scripts``: (language, what, times)."""
        languages = sorted(documents)
        number = {x: j for j, x in enumerate(languages)}
        known = sorted({g for _, g, _ in grams})
        place = {g: i for i, g in enumerate(known)}
        at = np.array([place[g] for _, g, _ in grams], np.int64)
        of = np.array([number[x] for x, _, _ in grams], np.int32)
        times = np.array([n for _, _, n in grams], np.float64)
        order = np.lexsort((of, at))
        totals = np.bincount(of, weights=times, minlength=len(languages)) if len(of) else np.zeros(len(languages))
        missing = np.log(0.5) - np.log(totals + 0.5 * (len(known) + 1))
        begins = np.searchsorted(at[order], np.arange(len(known) + 1))
        letters = Counter()
        for x, _, n in scripts:
            letters[x] += n
        candidates = {name: np.zeros(len(languages), bool) for name in {s for _, s, _ in scripts}}
        for x, name, n in scripts:
            candidates[name][number[x]] = n >= 0.01 * letters[x]
        common = max(languages, key=lambda x: (documents[x], x), default=UNKNOWN)
        self._set(languages, common, known, begins, of[order], np.log(2 * times[order] + 1), missing, candidates)

    def _set(self, *state):
        self.state = state
        self.languages, self.common, known, self.begins, self.of, self.over, self.missing, self.candidates = state
        self.gram_id = {g: i for i, g in enumerate(known)}

    @classmethod
    def restored(cls, state: tuple) -> Model:
        """The model whose ``state`` (plain values only) was sent."""
        own = cls.__new__(cls)
        own._set(*state)
        return own

    def gram_scores(self, words: list[str]) -> np.ndarray:
        """For each word and language the sum over its n-grams, but for a number that is equal for all languages (n-grams that none has)."""
        get, k = self.gram_id.get, len(self.languages)
        ids = np.array([get(g, -1) for w in words for g in grams_of(w)], np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])  # a word has a triple for each letter
        word, ids = word[ids >= 0], ids[ids >= 0]
        total = np.bincount(word, minlength=len(words))[:, None] * self.missing[None, :]
        begins = self.begins[ids]
        n = self.begins[ids + 1] - begins
        flat = np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return total + np.bincount(np.repeat(word, n) * k + self.of[flat], weights=self.over[flat], minlength=len(words) * k).reshape(-1, k)

    def score(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token its letters, whether it is scored, and its score for each language. Tokens without letters, or in
        scripts without candidates, are not scored."""
        words = [letters_of(t) for t in tokens]
        letters = np.fromiter(map(len, words), np.int64, len(words))
        scores = np.zeros((len(words), len(self.languages)))
        by_script: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w:
                by_script.setdefault(main_script(w), []).append(i)
        scored = np.zeros(len(words), bool)
        for script, at in by_script.items():
            fit = self.candidates.get(script)
            if fit is None or not fit.any():
                continue
            scored[at] = True
            found = np.full((len(at), len(self.languages)), -CAP)
            if fit.sum() == 1:
                found[:, fit] = 0.0
            else:
                total = self.gram_scores([words[i] for i in at])[:, fit]
                found[:, fit] = np.maximum(total - total.max(axis=1, keepdims=True), -CAP)
            scores[at] = found
        return letters, scored, scores


class Labeller:
    """Labels the words of texts; memoises the scores of words, within a bound of words and of bytes that is checked between texts."""

    def __init__(self, model: Model, penalty: float, entries: int = 200_000, most_bytes: int = 64 << 20):
        self.model, self.penalty = model, penalty
        self.entries = min(entries, most_bytes // (4 * max(1, len(model.languages))))  # a score of four bytes a language
        self._reset()

    def _reset(self):
        self.row: dict[str, int] = {}
        self.letters = np.zeros(1024, np.int64)
        self.scored = np.zeros(1024, bool)
        self.scores = np.zeros((1024, max(1, len(self.model.languages))), np.float32)

    def _learn(self, tokens: list[str]) -> None:
        """Add tokens that are not known yet."""
        first = len(self.row)
        self.row.update(zip(tokens, range(first, first + len(tokens)), strict=True))
        while len(self.row) > len(self.letters):
            self.letters, self.scored, self.scores = (np.concatenate([x, np.zeros_like(x)]) for x in (self.letters, self.scored, self.scores))
        new = slice(first, len(self.row))
        self.letters[new], self.scored[new], self.scores[new] = self.model.score(tokens)

    def label(self, text: str) -> tuple[str, float, np.ndarray]:
        """(language, share of letters, label of each blank-separated word; -1: none)."""
        labels = np.full(0, -1)
        if not self.model.languages:
            return UNKNOWN, 0.0, labels
        if len(self.row) > self.entries:
            self._reset()
        parts = []
        for tokens in words_in_parts(text):
            if missing := list({t: None for t in tokens if t not in self.row}):
                self._learn(missing)
            parts.append(np.fromiter(map(self.row.__getitem__, tokens), np.int32, len(tokens)))
        at = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        letters = self.letters[at]
        all_letters = int(letters.sum())
        labels = np.full(len(at), -1, np.int32)
        if not all_letters:
            return UNKNOWN, 0.0, labels
        told = np.flatnonzero(self.scored[at])
        if not len(told):
            return self.model.common, 0.0, labels
        labels[told] = viterbi(self.scores, self.penalty, at[told])
        weight = np.bincount(labels[told], weights=letters[told], minlength=len(self.model.languages))
        best = int(weight.argmax())
        return self.model.languages[best], float(weight[best] / all_letters), labels


def viterbi(scores: np.ndarray, penalty: float, at: np.ndarray | None = None, step: int = 1 << 16) -> np.ndarray:
    """The best labels of a sequence: sum of scores less ``penalty`` for each switch. ``at`` names the sequence's rows of ``scores``.

    If no stretch gains more than the penalty by leaving the label with the best sum, then that label throughout is best, and the
    recursion is not run: a path with ``m`` switches gains less than ``m`` penalties over it. Rows are taken ``step`` at a time; of
    the recursion, a bit for each row and label is kept (whether the best path stays), and each row's best label.
    """
    at = np.arange(len(scores)) if at is None else at
    n, k = len(at), scores.shape[1]
    if k == 1:
        return np.zeros(n, np.int32)

    def taken():
        for i in range(0, n, step):
            yield i, scores[at[i : i + step]].astype(np.float64)

    one = int(sum(x.sum(axis=0) for _, x in taken()).argmax())
    gained, low, most = 0.0, 0.0, -np.inf
    for _, x in taken():
        gain = gained + np.cumsum((np.delete(x, one, axis=1) - x[:, one : one + 1]).max(axis=1))
        lows = np.minimum(low, np.minimum.accumulate(np.concatenate([[gained], gain[:-1]])))
        most = max(most, float((gain - lows).max()))
        gained, low = float(gain[-1]), min(float(lows[-1]), float(gain[-1]))
    if most <= penalty:
        return np.full(n, one, np.int32)
    stays, best_of, value = np.empty((n, -(-k // 8)), np.uint8), np.empty(n, np.int32), None
    for i, x in taken():
        stay, bests = np.ones((len(x), k), bool), np.zeros(len(x), np.int32)
        for t, row in enumerate(x.tolist()):
            if value is not None:
                top = max(value)
                best = value.index(top)
                switch, kept = top - penalty, stay[t]
                bests[t] = best
                for j in range(k):
                    if value[j] >= switch:
                        row[j] += value[j]
                    else:
                        kept[j] = False
                        row[j] += switch
            value = row
        stays[i : i + len(x)], best_of[i : i + len(x)] = np.packbits(stay, axis=1), bests
    labels = np.empty(n, np.int32)
    now = labels[-1] = value.index(max(value))
    for t in range(n - 1, 0, -1):
        if not stays[t, now >> 3] >> (7 - (now & 7)) & 1:
            now = best_of[t]
        labels[t - 1] = now
    return labels


def learn(labelled: DataFrame, per_language: int = 2000, sample: int = 200_000, sample_chars: int = 1 << 30, max_languages: int | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn every language from a bounded sample: whole texts of at most ``per_language`` documents of each, and of
    ``sample`` documents in all if there are so many languages (one of each at least), chosen by a hash of the id; of a language whose texts are long, only the
    first of these, up to its share of ``sample_chars`` characters (and the one that passes it). All n-grams of the sample are kept. The model holds every language; a caller who cannot have more than ``max_languages`` gets an error beyond that.

    Rows with a null text, language or id are not learned from. No usable rows: a model without languages.
    """
    usable = labelled.select(named(id_col).cast("long").alias("id"), named(text_col).alias("text"), named(lang_col).cast("string").alias("lang")).dropna().withColumn("chars", F.length("text").cast("long"))
    counted = usable.groupBy("lang").count()
    documents = dict(map(tuple, (counted.limit(max_languages + 1) if max_languages else counted).collect()))
    if max_languages and len(documents) > max_languages:
        raise ValueError(f"more than {max_languages} languages to learn")
    if not documents:
        return Model([], [], {})
    wanted = max(1, min(per_language, sample // len(documents)))
    # Rows with the least hashes are chosen: of a frequent language only hashes under a bound that about twice the rows wanted pass are ranked.
    bounds = [(x, -(2**63) + min(2**64 - 1, 2**64 * 2 * wanted // n)) for x, n in documents.items()]
    bounds = F.broadcast(labelled.sparkSession.createDataFrame(bounds, "lang string, bound long"))  # a row for each language
    by_hash = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ranked = usable.select("id", "lang", "chars").join(bounds, "lang").filter(F.xxhash64("id") <= F.col("bound"))
    before = F.coalesce(F.sum("chars").over(by_hash.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = ranked.withColumns({"n": F.row_number().over(by_hash), "before": before})
    chosen = ranked.filter((F.col("n") <= wanted) & (F.col("before") < sample_chars // len(documents))).select("id", "lang").distinct()
    texts = spread(usable).join(F.broadcast(chosen), ["id", "lang"])  # ``sample`` ids at most, or one of each language

    def count(batches):
        for batch in batches:
            found: dict[tuple[str, str, str], int] = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for tokens in words_in_parts(text):
                    for token, n in Counter(tokens).items():
                        if word := letters_of(token):
                            for g in grams_of(word):
                                found[lang, "gram", g] += n
                            for c in word:
                                found[lang, "script", script_of(c)] += n
            keys = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.string()) for x in keys], pa.array(list(found.values()), pa.int64())], names=["lang", "kind", "what", "n"])

    sums = texts.select("lang", "text").mapInArrow(count, "lang string, kind string, what string, n long").groupBy("lang", "kind", "what").agg(F.sum("n").alias("n")).toArrow()
    rows = list(zip(*(sums.column(c).to_pylist() for c in ("kind", "lang", "what", "n")), strict=True))
    return Model([r[1:] for r in rows if r[0] == "gram"], [r[1:] for r in rows if r[0] == "script"], documents)


def identify(docs: DataFrame, model: Model, penalty: float = 12.0, text_col: str = "text", spans: bool = False) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score`` (replacing columns of those names, in any case), and with ``spans`` the
    labelled spans: ``lang_spans array<struct<lang, first, words>>``, in words separated by blanks.

    ``score`` is the share of the text's letters in words labelled with ``lang_pred``. A text that is null or has no
    letter is ``und`` with score 0; so is any text if no language was learned; a text in scripts that no learned language uses gets the
    commonest language with score 0. Nothing is shuffled; rows stay rows, repeated or with null ids; an empty table stays empty.
    """
    added = ["lang_pred", "score", *["lang_spans"] * spans]
    kept = rest(docs, *added)
    shared = docs.sparkSession.sparkContext.broadcast(model.state)

    def run(batches):
        labeller = Labeller(Model.restored(shared.value), penalty)
        names = labeller.model.languages
        for batch in sliced(batches):
            found = [labeller.label(t or "") for t in batch.column("0").to_pylist()]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            if spans:
                out = []
                for _, _, labels in found:
                    told = np.flatnonzero(labels >= 0)
                    edge = told[np.flatnonzero(np.diff(labels[told], prepend=-1) != 0)] if len(told) else told
                    out.append([{"lang": names[labels[a]], "first": int(a), "words": int(b - a)} for a, b in zip(edge, [*edge[1:], len(labels)], strict=False)])
                columns.append(pa.array(out, pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*batch.schema.names[1:], *added])

    # columns travel under numbers, so names may hold anything
    inner = docs.select(named(text_col).alias("0"), *[named(c).alias(str(i + 1)) for i, c in enumerate(kept)])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[1:]]
    schema = ", ".join([*fields, "lang_pred string", "score double", *["lang_spans array<struct<lang:string,first:bigint,words:bigint>>"] * spans])
    out = spread(inner).mapInArrow(run, schema)
    return out.select(*[F.col(str(i + 1)).alias(c) for i, c in enumerate(kept)], *added)


def fold(id_col: str = "doc_id"):
    """Remainder by three of the CRC-32 of an id as text: 1 is held out."""
    return F.crc32(named(id_col).cast("string").cast("binary")) % 3


def op5_language_id(spark, sf_dir):
    from ._common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.filter(fold() != 1))
    return identify(docs.select("doc_id", "text", F.coalesce(fold() == 1, F.lit(False)).alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")
