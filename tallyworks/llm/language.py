"""Language identification by Bayesian fusion of text, markup, address and host evidence."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import row_key, staged, unpacked, whole_row
from tallyworks.operators.skew import group_apart

#: The text model is fitted on about this many labelled texts of each language, chosen by hash ...
TRAIN_TEXTS = 400
#: ... of at most this many characters. Every label is a language.
TRAIN_CHARS = 20_000
#: Trigrams of bytes are counted in so many cells.
CELLS = 1 << 16
#: Trigrams overlap, so their evidence counts for less than if they were independent.
TEXT_WEIGHT = 1 / 3
#: Prior of text in none of the languages, which is modelled as uniform trigrams.
OTHER_PRIOR = 1e-3
OTHER = "und"
#: Rows that a parent's distribution counts for in its child's: all rows, domain, host.
SMOOTHING = 4.0

_TAGS = re.compile(rb"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>")
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


def _cells(data: bytes) -> np.ndarray:
    a = np.frombuffer(data.lower(), np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.uint32)
    return (((a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(16)


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of trigram cells by language; the last column stands for other text."""

    languages: tuple[str, ...]
    table: np.ndarray

    @staticmethod
    def fit(labelled: list[tuple[str, str]]) -> TextModel:
        languages = tuple(sorted({lang for _, lang in labelled}))
        table = np.full((CELLS, len(languages) + 1), -np.log(CELLS), np.float32)
        for i, lang in enumerate(languages):
            counts = np.full(CELLS, 0.05)
            for text, own in labelled:
                if own == lang:
                    counts += np.bincount(_cells(text.encode()), minlength=CELLS)
            table[:, i] = np.log(counts / counts.sum())
        return TextModel(languages, table)

    def scores(self, data: bytes) -> np.ndarray | None:
        """Log-likelihood of a text in each language; None if it has no letters."""
        if not _LETTER.search(data):
            return None
        total = np.zeros(self.table.shape[1])
        for at in range(0, len(data), 1 << 20):  # two bytes more, so no trigram is missed
            total += self.table[_cells(data[at : at + (1 << 20) + 2])].sum(axis=0, dtype=np.float64)
        return total * TEXT_WEIGHT


def train(labelled: DataFrame) -> TextModel:
    """Fit the text model on a bounded sample of rows with ``text`` and ``lang``, the same at each run."""
    known = labelled.where("lang is not null and text is not null")
    counts = staged(known.groupBy("lang").agg(F.count("*").alias("texts")), "language-labels")
    chance = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    short = known.where(F.length("text") <= TRAIN_CHARS).select("text", "lang").join(counts, "lang")
    sample = short.where(chance < F.lit(float(TRAIN_TEXTS)) / F.col("texts")).select("text", "lang").distinct()
    rows = sample.limit(2 * TRAIN_TEXTS * max(1, counts.count())).collect()  # a bound on chance, reached by no fair hash
    return TextModel.fit([(r.text, r.lang) for r in rows])


def _host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def identify(rows: DataFrame, model: TextModel, keys: list[str]) -> DataFrame:
    """Language and posterior of each row.

    ``rows`` has the key columns and text, markup (boolean: text is HTML), url, host and declared. Host is
    taken from the url where it has one; declared from the html element's lang attribute in markup. Any may
    be null and then bears no evidence. Results: keys, language, posterior, text_language, kept.

    Each row's posterior multiplies the text's likelihood, the chances of its declared language and its
    address suffix in each language, and a host prior. These are counts over all rows by the language that
    the text alone favours. A host's counts are smoothed by its domain's and these by all rows'; a row's own
    count is left out. A text without letters has no language: null, posterior 0, not kept. Text in none of the
    languages is ``und`` and not kept, nor is a language with a posterior under one half. Repeated rows give
    a row each; no rows give no rows.
    """
    size = len(model.languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, markup in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1), strict=True):
                data = text.as_py() or b""
                if markup.as_py():
                    data = _TAGS.sub(b" ", data)
                s = model.scores(data)
                found.append(None if s is None else s.tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(found, pa.list_(pa.float64()))], names=[*batch.schema.names[:-2], "scores"]
            )

    attribute = F.lower(F.regexp_extract("text", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    host = F.coalesce(_host(F.col("url")), F.lower("host"))
    plain = rows.select(
        *keys,
        host.alias("host"),
        F.coalesce(F.when(F.col("markup") & (attribute != ""), attribute), F.lower(F.regexp_extract("declared", r"^([^-_]+)", 1))).alias("declared"),
        F.when(F.col("url").isNotNull(), F.regexp_extract(host, r"\.([a-z0-9-]+)$", 1)).alias("suffix"),
        F.when(F.col("url").isNotNull(), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).alias("domain"),
        F.col("text").cast("binary").alias("text"),
        F.coalesce("markup", F.lit(False)).alias("markup"),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.drop("text", "markup").schema) + ", scores array<double>"
    scored = plain.mapInArrow(score, schema)
    best = F.array_position("scores", F.array_max("scores")).cast("int")
    scored = staged(scored.withColumn("best", F.when(F.col("scores").isNotNull(), best)), "language-scores")

    def counts(by: str | None) -> DataFrame:
        """Rows of each language that the text favours, as an array."""
        total = F.array(*[F.sum(F.when(F.col("best") == i + 1, 1.0).otherwise(0.0)) for i in range(size + 1)])
        known = scored.where("best is not null")
        if by is None:
            return known.agg(total.alias("n_all"))
        return group_apart(known.where(F.col(by).isNotNull()), [by], {f"n_{by}": total})

    every = counts(None).first().n_all  # one row
    every = np.array([x or 0.0 for x in every]) + 1.0
    every[-1] = 0.0
    prior = np.append(every[:-1] / every[:-1].sum() * (1 - OTHER_PRIOR), OTHER_PRIOR) if size else np.ones(1)
    base = F.array(*[F.lit(float(x)) for x in prior])
    own = F.transform(F.sequence(F.lit(1), F.lit(size + 1)), lambda i: F.when(i == F.col("best"), 1.0).otherwise(0.0))

    found = scored
    for by in ("host", "domain", "suffix", "declared"):
        found = found.join(counts(by), by, "left")

    def smoothed(n: str, parent: Column) -> Column:
        """A distribution over languages from counts without the row's own, smoothed by its parent's."""
        less = F.transform(F.arrays_zip(F.col(n).alias("n"), own.alias("o")), lambda x: F.greatest(x["n"] - x["o"], F.lit(0.0)))
        total = F.aggregate(less, F.lit(0.0), lambda a, x: a + x)
        mixed = F.zip_with(less, parent, lambda x, p: (x + p * SMOOTHING) / (total + SMOOTHING))
        return F.when(F.col(n).isNotNull() & F.col("best").isNotNull(), mixed).otherwise(parent)

    # P(evidence | language) is P(language | evidence) / P(language) up to a constant, so evidence enters as such ratios
    found = found.withColumn("p_domain", smoothed("n_domain", base)).withColumn("p_host", smoothed("n_host", F.col("p_domain")))
    found = found.withColumn("p_suffix", smoothed("n_suffix", base)).withColumn("p_declared", smoothed("n_declared", base))
    total = F.transform(
        F.arrays_zip("scores", "p_host", "p_suffix", "p_declared", base.alias("base")),
        lambda x: x["scores"] + F.log(x["p_host"]) + F.log(x["p_suffix"] / x["base"]) + F.log(x["p_declared"] / x["base"]),
    )
    found = found.withColumn("total", total).withColumn("top", F.array_max("total"))
    names = F.array(*[F.lit(x) for x in (*model.languages, OTHER)])
    weight = F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    language = F.element_at(names, F.array_position("total", F.col("top")).cast("int"))
    out = found.select(
        *keys,
        F.when(F.col("scores").isNotNull(), language).alias("language"),
        F.when(F.col("scores").isNotNull(), 1 / weight).otherwise(0.0).alias("posterior"),
        F.when(F.col("best").isNotNull(), F.element_at(names, F.col("best"))).alias("text_language"),
    )
    kept = (F.col("language") != OTHER) & (F.col("posterior") >= 0.5)
    return out.withColumn("kept", F.coalesce(kept, F.lit(False)))


def document_rows(docs: DataFrame, *keys: Column) -> DataFrame:
    """Documents as input of ``identify``: the source acts as the host. ``lang``, which the model is fitted on, is no evidence."""
    return docs.select(
        *keys,
        F.col("text").cast("string").alias("text"),
        F.lit(False).alias("markup"),
        F.lit(None).cast("string").alias("url"),
        F.col("source").cast("string").alias("host"),
        F.lit(None).cast("string").alias("declared"),
    )


def page_rows(pages: DataFrame, *keys: Column) -> DataFrame:
    """Web pages as input of ``identify``: host and suffix from the address, the declared language from markup."""
    none = F.lit(None).cast("string")
    return pages.select(
        *keys,
        F.col("html").cast("string").alias("text"),
        F.lit(True).alias("markup"),
        F.col("url").cast("string").alias("url"),
        none.alias("host"),
        none.alias("declared"),
    )


def identified_documents(docs: DataFrame) -> DataFrame:
    """The documents whose language was identified, all columns kept, whatever their names.

    See ``identify`` for what is rejected, null and empty texts among it. Repeated rows stay or go together; no rows give no rows.
    """
    keyed = docs.select(whole_row(docs).alias("row"), row_key(docs).alias("key"), "text", "source")
    found = identify(document_rows(keyed, F.col("key")), train(docs), ["key"])
    kept = group_apart(found, ["key"], {"kept": F.max("kept")}).where("kept").select("key")
    return unpacked(keyed.join(kept, "key", "left_semi"), docs)
