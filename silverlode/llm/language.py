"""Language of documents and pages by Bayesian fusion of four kinds of evidence.

* text: naive Bayes over letter trigrams of words, learned from labelled texts;
* markup: the language a page declares, wherever its <html> stands, trusted as often as a
  reliability says; documents declare none;
* address: a country suffix of the host, trusted less;
* host: what the host's other rows look like, shrunk towards its registered domain and
  that towards all rows. These priors are grouped sums over all rows, less the row's own part.

A row is rejected when no word of it can be judged or no language reaches ``ACCEPT``.

Edge cases. NULL, empty and wordless texts are rejected, without a language. Very long texts
are read whole, a declaration behind any length of attributes too. Of equally likely languages
the alphabetically last is named. Repeated rows are judged alike and count as often as they
stand in the priors, once in the fit. Empty tables give none; without labels all is rejected.
Columns with clashing names are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import copy_of, kept_for, picked, texts_of
from silverlode.session import stage

#: Labelled texts learned from, about; each language has a share of them, chosen by a hash.
FIT_ROWS = 2_000
#: Added to every trigram count.
SMOOTH = 0.5
#: A text's evidence is that of so many words at most: words of a text are not independent.
WORDS_COUNTED = 25.0
#: Letters of one word at most; a longer run without blanks counts as several words.
WORD_LETTERS = 20
#: How often a declared language is right, and a country suffix.
MARKUP_RIGHT, SUFFIX_RIGHT = 0.9, 0.7
#: Rows whose weight the wider level has in a host's and in a domain's prior.
HOST_SHRINK, DOMAIN_SHRINK = 20.0, 50.0
ACCEPT = 0.5
#: Languages that country suffixes speak for (fixed values).
SUFFIX_LANGUAGE = {"at": "de", "de": "de", "es": "es", "fr": "fr", "mx": "es", "uk": "en", "us": "en"}
DECLARED = r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})"
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
NOT_PROSE = re.compile(r"<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&[a-zA-Z#0-9]{1,10};", re.S | re.I)
LETTERS = re.compile(r"[^\W\d_]+")


def trigrams(word: str) -> list[str]:
    w = f" {word} "
    return [w[i : i + 3] for i in range(len(w) - 2)]


def kinds() -> np.ndarray:
    """For every code point: 1 for a letter, 2 for white space, else 0."""
    kept = kept_for("language")
    if "kinds" not in kept:
        signs = map(chr, range(0x110000))
        kept["kinds"] = np.fromiter((2 if c.isspace() else c.isalnum() and not c.isdecimal() for c in signs), np.int8, 0x110000)
    return kept["kinds"]


class TextModel:
    """Log-likelihood of texts in each language, by the trigrams of their words."""

    def __init__(self, languages: list[str], table: dict[str, np.ndarray], unseen: np.ndarray):
        self.languages = languages
        grams = sorted(table, key=self._packed)
        self.known = np.array([self._packed(g) for g in grams], np.int64)
        self.logs = np.array([table[g] for g in grams] + [unseen], float).reshape(len(grams) + 1, len(languages))

    @staticmethod
    def _packed(gram: str) -> int:
        return ord(gram[0]) << 42 | ord(gram[1]) << 21 | ord(gram[2])

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihoods, words judged) of whole texts.

        A chunk without blanks counts where one of its trigrams is known. It may be a whole
        text: it counts as a word for each begun ``WORD_LETTERS`` letters, so that its
        weight is that of its letters.
        """
        scores, judged = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        lowered = [t.lower() for t in texts]
        sizes = np.array([len(t) for t in lowered], np.int64)
        # about a million characters at a time; a longer text is one part
        part = (np.cumsum(sizes) - sizes) // 1_000_000
        for lo, hi in zip(np.searchsorted(part, np.unique(part)), np.searchsorted(part, np.unique(part), "right"), strict=True):
            scores[lo:hi], judged[lo:hi] = self._part(lowered[lo:hi], sizes[lo:hi])
        return scores, judged

    def _part(self, lowered: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(lowered), len(self.languages)
        signs = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = kinds()[signs]
        at = np.flatnonzero(kind == 1)
        if not len(at) or not len(self.known):
            return np.zeros((n, k)), np.zeros(n, np.int64)
        letter = np.where(kind == 1, signs, 32).astype(np.int64)
        gram = letter[at - 1] << 42 | letter[at] << 21 | letter[at + 1]
        row = np.minimum(np.searchsorted(self.known, gram), len(self.known) - 1)
        known = self.known[row] == gram
        row[~known] = len(self.known)
        chunk = np.cumsum(kind == 2)[at]
        first = np.flatnonzero(np.r_[True, np.diff(chunk) != 0])
        letters = np.diff(np.r_[first, len(at)])
        counts = np.logical_or.reduceat(known, first)
        text = np.searchsorted(np.cumsum(sizes + 1), at, "right")  # texts stand behind one blank each
        kept = np.repeat(counts, letters)
        text_of, row = text[kept], row[kept]
        total = np.stack([np.bincount(text_of, self.logs[row, j], n) for j in range(k)], 1).astype(float)
        words = np.bincount(text[first][counts], -(-letters[counts] // WORD_LETTERS), n)
        total *= np.minimum(1.0, WORDS_COUNTED / np.maximum(words, 1))[:, None]
        return np.where(words[:, None] > 0, total - total.max(1, keepdims=True), 0.0), words.astype(np.int64)

    def text(self, text: str) -> tuple[np.ndarray, int]:
        """(log-likelihoods, words judged) of a whole text."""
        scores, judged = self.texts([text])
        return scores[0], int(judged[0])


def grams_of(rows: Iterable[tuple[str, str]]) -> dict[str, Counter]:
    """Trigrams of the words of (language, text) rows, for each language."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for language, text in rows:
        words = Counter(LETTERS.findall((text or "").lower()))
        for w, n in words.items():
            for g in trigrams(w):
                counts[language][g] += n
    return counts


def modelled(counts: dict[str, Counter]) -> TextModel:
    """Model of trigram counts. Without any no language is known."""
    languages = sorted(counts)
    grams = sorted(set().union(*counts.values())) if counts else []
    sizes = np.array([sum(counts[x].values()) for x in languages]) + SMOOTH * (len(grams) + 1)
    table = {g: np.log((np.array([counts[x][g] for x in languages]) + SMOOTH) / sizes) for g in grams}
    return TextModel(languages, table, np.log(SMOOTH / sizes))


def learn(rows: list[tuple[str, str]]) -> TextModel:
    """Model of (language, text) rows, a bounded list. Without rows no language is known."""
    return modelled(grams_of(rows))


def fair_share(sizes: list[int], most: int) -> int:
    """Rows each language may keep, so that all together have about ``most``; at least 1."""
    left = most
    for i, n in enumerate(sorted(sizes)):
        share = left // (len(sizes) - i)
        if n > share:
            return max(1, share)
        left -= n
    return max(1, max(sizes, default=1))


def fitted_rows(d: DataFrame) -> DataFrame:
    """All different (id, text, lang) rows while there are at most ``FIT_ROWS``, else a share of each language.

    Rows are chosen by a hash, the same on any layout, without sorting. Copies of a row
    count once. A language with no more texts than its share keeps all of them.
    """
    if d.count() <= FIT_ROWS:
        return d.distinct()
    # hashes cut into 2**30 turns; the threshold of a language admits about its share
    turn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    sizes = d.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("id", "text")).alias("n"), F.min(turn).alias("least"))
    sizes = stage(sizes, "languages")
    share = fair_share([r["n"] for r in sizes.select("n").collect()], FIT_ROWS)
    below = F.when(F.col("n") <= share, F.lit(1 << 30)).otherwise(F.greatest(F.col("least") + 1, (F.lit(float(share)) / F.col("n") * (1 << 30)).cast("long")))
    sizes = sizes.select(F.col("lang").alias("of"), below.alias("below"))
    return d.join(sizes, (F.col("lang") == F.col("of")) & (turn < F.col("below"))).select("id", "text", "lang").distinct()


def learned_from(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> TextModel:
    """Model of whole texts of a bounded sample of labelled rows; NULL labels teach nothing."""
    d = picked(labelled, id=key, text=text, lang=lang).where("lang is not null")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for language, grams in grams_of(zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True)).items():
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(grams), pa.string()), pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["lang", "gram", "n"])

    counts: dict[str, Counter] = defaultdict(Counter)
    found = fitted_rows(d).select("lang", "text").mapInArrow(counted, "lang string, gram string, n long")
    for r in found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect():
        counts[r["lang"]][r["gram"]] = r["n"]
    return modelled(counts)


def evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """(origin, id, copy, host, domain, declared, suffix, likely, judged) of (origin, id, copy, text, url, host)."""
    named = F.lower(F.coalesce(F.nullif(F.regexp_extract("url", HOST, 1), F.lit("")), "host"))
    page = F.col("url").isNotNull()
    # a declaration may follow a preamble of any length; documents have no markup to declare in
    declared = F.when(page, F.lower(F.nullif(F.regexp_extract("text", DECLARED, 1), F.lit(""))))
    facts = rows.select("origin", "id", "copy", "text", named.alias("host"), declared.alias("declared"), page.alias("page"))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            pages = b.column("page").to_pylist()
            plain = [NOT_PROSE.sub(" ", t) if page and ("<" in t or "&" in t) else t for t, page in zip(texts_of(b), pages, strict=True)]
            scores, judged = m.texts(plain)
            likely = list(scores)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("origin", "id", "copy", "host", "declared")), pa.array(likely, pa.list_(pa.float64())), pa.array(judged, pa.int64())], ["origin", "id", "copy", "host", "declared", "likely", "judged"])

    out = facts.mapInArrow(run, "origin string, id long, copy long, host string, declared string, likely array<double>, judged long")
    parts = F.split("host", r"\.")
    domain = F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.col("host"))
    suffix = F.when(F.size(parts) >= 2, F.create_map(*[F.lit(x) for kv in SUFFIX_LANGUAGE.items() for x in kv])[F.element_at(parts, -1)])
    return out.withColumn("domain", domain).withColumn("suffix", suffix)


def trusted(said: str, right: float, languages: list[str]) -> list[Column]:
    """Log-likelihood of what ``said`` claims, for each language; zero where it claims no known one."""
    known = F.coalesce(F.col(said).isin(languages), F.lit(False))
    wrong = (1 - right) / max(1, len(languages) - 1)
    return [F.when(known & (F.col(said) == x), F.log(F.lit(right))).when(known, F.log(F.lit(max(wrong, 1e-12)))).otherwise(F.lit(0.0)) for x in languages]


def shares(scores: list[Column]) -> list[Column]:
    """Normalised exponentials of log scores."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def judged(rows: DataFrame, model: TextModel) -> DataFrame:
    """(origin, id, copy, lang, posterior, accepted), one per row of (origin, id, copy, text, url, host).

    NULL or empty texts have no judged word: lang NULL, posterior 0, rejected. Rows
    without host form no group; their prior is that of all other rows.
    """
    languages = model.languages
    if not languages:
        return rows.select("origin", "id", "copy", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"))
    k = len(languages)
    seen = evidence(rows, model)
    text = [F.col("likely")[i] for i in range(k)]
    markup, suffix = trusted("declared", MARKUP_RIGHT, languages), trusted("suffix", SUFFIX_RIGHT, languages)
    own = [a + b + c for a, b, c in zip(text, markup, suffix, strict=True)]
    seen = seen.withColumns({f"own{i}": c for i, c in enumerate(own)})
    # soft counts: hosts, then domains, then everything; a row's own part is taken out of its priors
    soft = shares([F.col(f"own{i}") for i in range(k)])
    seen = seen.withColumns({f"s{i}": F.when(F.col("judged") > 0, c).otherwise(F.lit(0.0)) for i, c in enumerate(soft)})
    # written with both, so that later expressions start from columns again
    seen = stage(seen.drop("likely", "declared", "suffix"), "evidence")
    hosts = seen.where("judged > 0").groupBy("host", "domain").agg(*[F.sum(f"s{i}").alias(f"h{i}") for i in range(k)])
    hosts = stage(hosts, "hosts")
    everything = hosts.agg(*[F.coalesce(F.sum(f"h{i}"), F.lit(0.0)) for i in range(k)]).first()
    domains = hosts.where("domain is not null").groupBy("domain").agg(*[F.sum(f"h{i}").alias(f"d{i}") for i in range(k)])
    both = seen.join(hosts.where("host is not null").join(domains, "domain").drop("domain"), "host", "left")

    def others(of: list[Column]) -> list[Column]:
        return [F.greatest(F.coalesce(c, F.lit(0.0)) - F.col(f"s{i}"), F.lit(0.0)) for i, c in enumerate(of)]

    def shrunk(counts: list[Column], weight: float, wider: list[Column]) -> list[Column]:
        total = sum(counts[1:], counts[0])
        return [(c + weight * w) / (total + weight) for c, w in zip(counts, wider, strict=True)]

    prior = shrunk(others([F.lit(x) for x in everything]), float(k), [F.lit(1.0 / k)] * k)
    for level, weight in (("d", DOMAIN_SHRINK), ("h", HOST_SHRINK)):
        names = [f"{level}_prior{i}" for i in range(k)]
        both = both.withColumns(dict(zip(names, prior, strict=True)))
        shifted = shrunk(others([F.col(f"{level}{i}") for i in range(k)]), weight, [F.col(c) for c in names])
        prior = [F.when(F.col("host").isNull(), F.col(c)).otherwise(p) for c, p in zip(names, shifted, strict=True)]
    total = [F.col(f"own{i}") + F.log(p) for i, p in enumerate(prior)]
    ranked = F.array_max(F.array(*[F.struct(c.alias("score"), F.lit(x).alias("lang")) for c, x in zip(total, languages, strict=True)]))
    both = both.withColumns({"best": F.when(F.col("judged") > 0, ranked), "scores": F.array(*total)})
    share = 1 / F.aggregate("scores", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x - F.col("best.score")))
    both = both.withColumn("posterior", F.when(F.col("judged") > 0, share).otherwise(F.lit(0.0)))
    accepted = (F.col("judged") > 0) & (F.col("posterior") >= ACCEPT)
    return both.select("origin", "id", "copy", F.col("best.lang").alias("lang"), "posterior", accepted.alias("accepted"))


def document_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Documents as rows to judge; their source stands for the host."""
    return picked(docs, id=key, text=text, host=source).select(F.lit("documents").alias("origin"), F.col("id").cast("long").alias("id"), copy_of("text").alias("copy"), "text", F.lit(None).cast("string").alias("url"), "host")


def page_rows(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """Web pages as rows to judge."""
    return picked(pages, id=key, text=html, url=url).select(F.lit("pages").alias("origin"), F.col("id").cast("long").alias("id"), copy_of("text").alias("copy"), "text", F.coalesce("url", F.lit("")).alias("url"), F.lit(None).cast("string").alias("host"))
