"""Languages of documents and of their sentences, where labels are missing or wrong.

A linear-chain conditional random field labels every word of a document: a word's
features are the word, its beginnings and ends, its letter 3-grams and the lexicons
it is in; transitions between languages are learned with them, and forward-backward
gives each word's probabilities in its context. A segment takes the language with
the largest sum over its words, and the mean probability as its confidence.

The field is fitted here, on at most SAMPLE_PER_LABEL documents per label of up to
SAMPLE_CHARS characters each. Their labels are noisy and some mix languages, so each
sentence gets its own label first: the document's label is the prior, and the counts
of the sentence's words over the sentences of every language, with the lexicons as
pseudo-counts, must outweigh it. A word of several languages is in the lexicon of
each, so it speaks for none of them alone. Everything else covers all documents and
whole texts.

Defined results for odd input: null, empty and blank texts, and texts of numbers,
codes, signs and units only, have no segment and give no rows; a segment has at
least one word of two letters with a vowel, and is a whole sentence if it has
WHOLE_WORDS different ones; shorter segments have their row too, with ``whole``
false; with no labelled document the lexicons alone decide; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions.text import FOLD_FROM, FOLD_TO
from siteweave.storage import ship

LANGUAGES = ("en", "es", "fr", "de", "pt", "it")
SAMPLE_PER_LABEL = 400
SAMPLE_CHARS = 4_000
#: Different words that make a segment a whole sentence.
WHOLE_WORDS = 3
BUCKETS = 1 << 15
#: Rounds of the fit, fewer once the mean log likelihood of a word has not gained GAIN for PATIENCE rounds.
ROUNDS, GAIN, PATIENCE = 40, 0.001, 2
#: Step of the fit, and the weight of counts at its start.
RATE, START = 0.03, 0.06
#: The fit cuts documents into runs of sentences of about so many words.
RUN_WORDS = 60
MEMO_WORDS = 200_000
#: Log odds that a document's own label gives to each of its sentences, before its words are looked at.
LABEL_PRIOR = 4.0
#: Occurrences that a lexicon stands for, and documents a word must be in to count.
LEXICON_COUNT, WORD_DOCUMENTS = 5.0, 3

# Frequent function words of each language; a word of several languages is in each list.
LEXICON = {
    "en": "a an and are as at be but by for from has have if in is it its may no not of on only or that the this to was were which who will with".split(),
    "es": "a al cada como con cuando de del desde donde el en entre es está esta este fue ha han hasta la las lo los más muy no o para pero por que se según si sin sobre su sus también un una y ya".split(),
    "fr": "a au aux avec ce cette dans de des dont du elle en est et été il la le les leur mais ne nous on ont ou où par pas plus pour que qui sa sans se ses si son sont sur un une y".split(),
    "de": "aber als am an auch auf aus bei das dass dem den der des die ein eine einen einer es für hat im in ist mit nach nicht noch nur oder sich und vom von war werden wie wird zu".split(),
    "pt": "a à ao aos as até com como da das de do dos e é em está esta este foi foram há já mais mas na nas não no nos o os ou para pela pelo por que são se sem seu sobre sua um uma".split(),
    "it": "a al alla anche ancora che come con da dal dalla dei del della delle di e è gli ha i il in la le lo ma nel nella non o per più questa questo se si sono su sul tra un una uno".split(),
}
# Names of the languages in common notations, after folding.
LABELS = {
    "en": ("en", "eng", "english", "ingles", "anglais", "englisch", "inglese"),
    "es": ("es", "spa", "esp", "spanish", "espanol", "castellano", "spanisch", "espagnol", "spagnolo"),
    "fr": ("fr", "fra", "fre", "french", "francais", "frances", "franzosisch", "francese"),
    "de": ("de", "deu", "ger", "german", "deutsch", "aleman", "allemand", "alemao", "tedesco"),
    "pt": ("pt", "por", "portuguese", "portugues", "portugais", "portugiesisch", "portoghese"),
    "it": ("it", "ita", "italian", "italiano", "italien", "italienisch"),
}

_FOLD = str.maketrans(FOLD_FROM, FOLD_TO)
_SKIP = re.compile(r"(?:https?://|www\.)\S+|\S+@\S+\.\S+|<\|[^|>]*\|>", re.IGNORECASE)
_SKIP_SIGNS = ("://", "@", "<|", "www.", "WWW.")
_END = re.compile(r"[.!?…][\"'»”’)\]]*(?=\s)|\n[ \t\r]*\n")
_WORD = re.compile(r"\b[^\W\d_]+\b")
_SPOKEN = re.compile(r"(?=.*[aeiouyàáâãäåèéêëìíîïòóôõöùúûüÿœæ])..", re.IGNORECASE)


def label_language(c: Column) -> Column:
    """The language that a label names in any usual notation; null for none."""
    bare = F.translate(F.lower(F.trim(c)), FOLD_FROM, FOLD_TO)
    word = F.regexp_extract(bare, r"^([a-z]+)(?:[-_. (].*)?$", 1)
    pairs = [F.lit(x) for code, names in LABELS.items() for name in names for x in (name, code)]
    return F.try_element_at(F.create_map(*pairs), word)


def split_sentences(text: str) -> list[tuple[int, int]]:
    """Spans between sentence ends; a line break alone is none."""
    spans, start = [], 0
    for end in _END.finditer(text):
        spans.append((start, end.end()))
        start = end.end()
    if start < len(text):
        spans.append((start, len(text)))
    return spans


def words_of(text: str) -> list[str]:
    """Words of letters; apostrophes part them; addresses of pages, of mail and marks are skipped."""
    if any(sign in text for sign in _SKIP_SIGNS):
        text = _SKIP.sub(" ", text)
    return _WORD.findall(text)


def spoken(word: str) -> bool:
    """Whether it is a word and no unit or code: two letters or more and a vowel."""
    return _SPOKEN.match(word) is not None


def _features(word: str) -> list[int]:
    low = word.lower()
    folded = low.translate(_FOLD)
    padded = f"^{folded}$"
    names = [f"w{low}", f"f{folded}", *(f"p{low[:n]}" for n in (1, 2, 3) if len(low) > n), *(f"s{low[-n:]}" for n in (1, 2, 3, 4) if len(low) > n)]
    names += [f"g{padded[i : i + 3]}" for i in range(len(padded) - 2)]
    names += [f"x{code}" for code, words in _lexicons().items() if low in words or folded in words]
    names.append("b")
    return sorted({zlib.crc32(n.encode()) % BUCKETS for n in names})


_lex: dict[str, set[str]] = {}


def _lexicons() -> dict[str, set[str]]:
    if not _lex:
        for code, words in LEXICON.items():
            _lex[code] = {*words, *(w.translate(_FOLD) for w in words)}
    return _lex


class LanguageField:
    """Weights of features and transitions, and forward-backward over batches of word sequences."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> None:
        self.weights, self.transitions, self.start = weights, transitions, start
        self.forget()

    def forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.spoken: set[int] = set()
        self.table = np.zeros((1024, len(LANGUAGES)), dtype=np.float32)

    def number(self, words: list[str]) -> list[int]:
        """The words as rows of the table of emissions (their exponentials, the largest 1), which is filled as words are met."""
        out = list(map(self.ids.get, words))
        if None in out:
            for word in words:
                if word not in self.ids:
                    k = self.ids[word] = len(self.ids)
                    if k == len(self.table):
                        self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                    score = self.weights[_features(word)].sum(0)
                    self.table[k] = np.exp(score - score.max())
                    if spoken(word):
                        self.spoken.add(k)
            out = list(map(self.ids.get, words))
        return out

    def marginals(self, sequences: list[list[int]]) -> np.ndarray:
        """Probabilities (words, languages) of all words of all sequences of numbered words, one after the other."""
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        flat = np.array([w for s in sequences for w in s], dtype=np.int64)
        out = np.empty((len(flat), len(LANGUAGES)), dtype=np.float32)
        begins = np.cumsum(lengths) - lengths
        # Sequences of like length go together.
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        at = 0
        while at < len(order):
            end = min(len(order), at + 2048)
            while end - at > 1 and (end - at) * lengths[order[end - 1]] > 400_000:
                end = at + max(1, (end - at) // 2)
            group = order[at:end]
            at = end
            sizes = lengths[group]
            steps = np.arange(sizes.max())[:, None]
            valid = steps < sizes
            where = np.where(valid, begins[group] + steps, 0)
            probable, _ = _passes(self.table[flat[where]], sizes, self.transitions, self.start, counts=False)
            out[where[valid]] = probable[valid]
        return out


def forward_backward(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (batch, words, labels) and expected transition counts."""
    local = np.exp(scores - scores.max(2, keepdims=True))
    joint, expected = _passes(np.ascontiguousarray(local.transpose(1, 0, 2)), sizes, transitions, start)
    return joint.transpose(1, 0, 2), expected


def _passes(local: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, start: np.ndarray, counts: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Both passes over (words, batch, labels), on probabilities rescaled at every step; overwrites ``local``."""
    longest, batch, labels = local.shape
    move = np.exp(transitions).astype(local.dtype)
    ahead, scale = np.empty_like(local), np.empty((longest, batch, 1), dtype=local.dtype)
    step = local[0] * np.exp(start).astype(local.dtype)
    for t in range(longest):
        if t:
            np.matmul(ahead[t - 1], move, out=step)
            step *= local[t]
        np.sum(step, axis=1, keepdims=True, out=scale[t])
        np.divide(step, scale[t], out=ahead[t])
    local /= scale
    back = np.empty_like(local)
    expected = np.zeros((labels, labels))
    back[-1] = 1.0
    live = np.arange(longest)[:, None] < sizes
    whole = live.all(1)
    reverse = np.ascontiguousarray(move.T)
    for t in range(longest - 2, -1, -1):
        carry = local[t + 1] * back[t + 1]
        np.matmul(carry, reverse, out=back[t])
        if not whole[t + 1]:
            inside = live[t + 1][:, None]
            back[t] = np.where(inside, back[t], 1.0)
            carry *= inside
        if counts:
            expected += ahead[t].T @ carry
    ahead *= back
    ahead /= np.maximum(ahead.sum(2, keepdims=True), 1e-30)
    return ahead, move * expected


def _sentence_labels(documents: list[list[list[str]]], given: list[int]) -> list[list[int]]:
    """A language for each sentence of each document: the document's own unless the sentence's words outweigh it."""
    n = len(LANGUAGES)
    seen: dict[str, set[int]] = defaultdict(set)
    for k, sentences in enumerate(documents):
        for words in sentences:
            for word in words:
                seen[word.lower()].add(k)
    base: dict[str, np.ndarray] = {w: np.zeros(n) for w, docs in seen.items() if len(docs) >= WORD_DOCUMENTS}
    for k, code in enumerate(LANGUAGES):
        for word in _lexicons()[code]:
            base.setdefault(word, np.zeros(n))[k] += LEXICON_COUNT
    rows = {w: k for k, w in enumerate(base)}
    pseudo = np.array(list(base.values()))
    coded = [[[rows[w] for w in map(str.lower, words) if w in rows] for words in sentences] for sentences in documents]
    labels = [[language] * len(sentences) for sentences, language in zip(documents, given)]
    for _ in range(3):
        count = pseudo.copy()
        for sentences, own in zip(coded, labels):
            for words, language in zip(sentences, own):
                np.add.at(count[:, language], words, 1)
        logs = np.log((count + 0.3) / (count.sum(0) + 0.3 * len(count)))
        for sentences, own, language in zip(coded, labels, given):
            for k, words in enumerate(sentences):
                score = logs[words].sum(0)
                score[language] += LABEL_PRIOR
                own[k] = int(score.argmax())
    return labels


def _runs(documents: list[list[list[str]]], labels: list[list[int]]) -> Iterator[tuple[list[str], list[int]]]:
    """Words and their languages of runs of sentences of about RUN_WORDS words."""
    for sentences, own in zip(documents, labels):
        words: list[str] = []
        ids: list[int] = []
        for sentence, language in zip(sentences, own):
            words += sentence
            ids += [language] * len(sentence)
            if len(words) >= RUN_WORDS:
                yield words, ids
                words, ids = [], []
        if words:
            yield words, ids


class _Sums:
    """Sums of rows by a fixed index, sorted once."""

    def __init__(self, index: np.ndarray) -> None:
        self.order = np.argsort(index, kind="stable")
        self.where, self.first = np.unique(index[self.order], return_index=True)

    def into(self, target: np.ndarray, rows: np.ndarray) -> None:
        target[self.where] += np.add.reduceat(rows[self.order], self.first, axis=0)


def fit_field(texts: list[str], given: list[str]) -> LanguageField:
    """Conditional maximum likelihood with Adagrad over the whole sample in every round."""
    n = len(LANGUAGES)
    weights, transitions, start = np.zeros((BUCKETS, n)), np.zeros((n, n)), np.zeros(n)
    for k, code in enumerate(LANGUAGES):
        weights[zlib.crc32(f"x{code}".encode()) % BUCKETS, k] = 1.0
    transitions += 2.0 * np.eye(n)
    documents = [[words_of(t[a:b]) for a, b in split_sentences(t)] for t in texts]
    runs = list(_runs(documents, _sentence_labels(documents, [LANGUAGES.index(g) for g in given])))
    if not runs:
        return LanguageField(weights, transitions, start)
    kinds: dict[str, int] = {}
    coded = [np.array([kinds.setdefault(w, len(kinds)) for w in words]) for words, _ in runs]
    lists = [_features(w) for w in kinds]
    first = np.cumsum([0, *map(len, lists)])[:-1]
    flat = np.concatenate([np.array(x) for x in lists])
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    by_feature = _Sums(flat)
    groups = []
    order = sorted(range(len(coded)), key=lambda i: len(coded[i]))
    for at in range(0, len(order), 2048):
        ids = order[at : at + 2048]
        sizes = np.array([len(coded[i]) for i in ids])
        valid = np.arange(sizes.max())[None, :] < sizes[:, None]
        words, want = np.zeros(valid.shape, dtype=int), np.zeros(valid.shape, dtype=int)
        words[valid] = np.concatenate([coded[i] for i in ids])
        want[valid] = np.concatenate([runs[i][1] for i in ids])
        pair = valid[:, 1:]
        moves = np.bincount(want[:, :-1][pair] * n + want[:, 1:][pair], minlength=n * n).reshape(n, n)
        groups.append((words, np.eye(n)[want[valid]], np.eye(n)[want[:, 0]], moves, sizes, valid, _Sums(words[valid])))
    total = sum(len(s) for s in coded)
    # The start: how much more often than by chance a feature stands in a language, shared among the features of a word.
    seen, often = np.zeros((len(lists), n)), np.zeros_like(weights)
    for _words, want, *_rest, by_word in groups:
        by_word.into(seen, want)
    by_feature.into(often, seen[owner])
    share = (often + 0.5) / (often.sum(1, keepdims=True) + 0.5 * n)
    weights += START * np.where(often.sum(1, keepdims=True) > 0, np.log(share) - np.log(share).mean(1, keepdims=True), 0.0)
    past = [np.full_like(x, 1e-6) for x in (weights, transitions, start)]
    before, still = -np.inf, 0
    for _ in range(ROUNDS):
        emission = np.add.reduceat(weights[flat], first, axis=0).astype(np.float32)
        by_kind, by_move, by_start, likely = np.zeros((len(lists), n)), np.zeros_like(transitions), np.zeros_like(start), 0.0
        for words, want, opening, moves, sizes, valid, by_word in groups:
            probable, expected = forward_backward(emission[words], sizes, transitions, start)
            here = probable[valid]
            by_word.into(by_kind, want - here)
            likely += float(np.log(np.maximum((here * want).sum(1), 1e-12)).sum())
            by_move += moves - expected
            by_start += (opening - probable[:, 0]).sum(0)
        gradient = np.zeros_like(weights)
        by_feature.into(gradient, by_kind[owner])
        for value, slope, known in ((weights, gradient / total - 1e-6 * weights, past[0]), (transitions, by_move / total - 1e-6 * transitions, past[1]), (start, by_start / total - 1e-6 * start, past[2])):
            known += slope * slope
            value += RATE * slope / np.sqrt(known)
        likely /= total
        still = 0 if likely > before + GAIN else still + 1
        before = max(before, likely)
        if still == PATIENCE:
            break
    return LanguageField(weights, transitions, start)


def sample_labelled(documents: DataFrame, key: str, text: str, label: str) -> tuple[list[str], list[str]]:
    """At most SAMPLE_PER_LABEL documents of each label, of up to SAMPLE_CHARS characters, by the order of their keys' digests."""
    rows = documents.select(F.xxhash64(F.col(key)).alias("h"), F.col(text).alias("text"), label_language(F.col(label)).alias("label"))
    rows = rows.where(F.col("label").isNotNull() & (F.length("text") <= SAMPLE_CHARS) & (F.length(F.trim("text")) > 20))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not counts:
        return [], []
    # Twice as many as wanted are let through, the least digests of them kept.
    share = F.create_map(*[x for code, n in counts.items() for x in (F.lit(code), F.lit(min(1.0, 2 * SAMPLE_PER_LABEL / n)))])
    some = rows.where(F.pmod("h", F.lit(1_000_000)) < share[F.col("label")] * 1_000_000)
    texts, labels, taken = [], [], defaultdict(int)
    for r in some.orderBy(F.pmod("h", F.lit(1_000_000)), "h").limit(3 * SAMPLE_PER_LABEL * len(LANGUAGES)).collect():
        if taken[r["label"]] < SAMPLE_PER_LABEL:
            taken[r["label"]] += 1
            texts.append(r["text"])
            labels.append(r["label"])
    return texts, labels


_fields: dict[str, LanguageField] = {}


def sentence_languages(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(key, sentence, first, length, lang, confidence, words, whole): every segment with its language; offsets in code points."""
    spark = documents.sparkSession
    ship(spark)
    field = fit_field(*sample_labelled(documents, key, text, label))
    name = str(zlib.crc32(field.weights.tobytes()))
    shared = spark.sparkContext.broadcast((field.weights.astype(np.float32), field.transitions, field.start))
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    kind = rows.schema["key"].dataType.simpleString()
    columns = ["key", "sentence", "first", "length", "lang", "confidence", "words", "whole"]

    def label_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _fields:
            _fields.clear()
            _fields[name] = LanguageField(*shared.value)
        model = _fields[name]
        for batch in batches:
            if len(model.ids) > MEMO_WORDS:
                model.forget()
            out: list[tuple] = []
            sequences: list[list[int]] = []
            begins: list[int] = []
            kept: list[bool] = []
            at = 0
            for ident, content in zip(batch["key"], batch["text"]):
                number = 0
                sequence: list[int] = []
                for a, b in split_sentences(content):
                    words = model.number(words_of(content[a:b]))
                    if words:
                        different = len(model.spoken.intersection(words))
                        begins.append(at + len(sequence))
                        kept.append(different > 0)
                        sequence += words
                        if different:
                            out.append((ident, number, a, b - a, len(words), different >= WHOLE_WORDS))
                            number += 1
                sequences.append(sequence)
                at += len(sequence)
            if not out:
                continue
            score = np.add.reduceat(model.marginals(sequences), begins, axis=0)[np.array(kept)]
            frame = pd.DataFrame(out, columns=["key", "sentence", "first", "length", "words", "whole"])
            frame["lang"] = np.array(LANGUAGES)[score.argmax(1)]
            frame["confidence"] = np.minimum(score.max(1) / frame["words"].to_numpy(), 1.0)
            yield frame[columns]

    schema = f"key {kind}, sentence int, first int, length int, lang string, confidence double, words int, whole boolean"
    return rows.mapInPandas(label_batches, schema).withColumnRenamed("key", key)
