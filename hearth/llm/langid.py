"""Language identification by Bayesian evidence fusion (operator 3).

A page's language is the one with the largest posterior, from four pieces of evidence:
the likelihood of its visible text under byte-trigram models, the language its markup
declares, its address's suffix, and the languages of its host.

The text models are fitted on a bounded sample of labelled documents.  All else is
counted over all pages, by grouped aggregation of the text's own posteriors: how
often a language comes with a declaration or a suffix, and how it is spread over the pages of a
host.  A host's prior is smoothed by its domain's, that by its suffix's, and
that by the overall one, each without the page itself.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import by_turns, cut, text_or_empty
from hearth.session import ship_package

SLOTS = 1 << 16
#: Training rows per language (those of the smallest id hash) and characters in all.
ROWS_PER_LANGUAGE, TRAIN_CHARS = 400, 12_000_000
#: Trigrams overlap and repeat, so their evidence counts as that of so many at most.
EVIDENCE = 200.0
#: Weight of the wider prior at each level, and of a uniform count for declarations and suffixes.
SMOOTH, EVEN = 5.0, 1.0

_HIDDEN = re.compile(r"<(?:(script|style|noscript)\b|!--)", re.IGNORECASE)
_HIDDEN_END = {"script": re.compile(r"</script\s*>", re.IGNORECASE), "style": re.compile(r"</style\s*>", re.IGNORECASE),
               "noscript": re.compile(r"</noscript\s*>", re.IGNORECASE), None: re.compile("-->")}
_TAG = re.compile(r"<[^>]*>")


def visible(page: str) -> str:
    """The text a reader sees: without scripts, styles, comments and tags, entities decoded.

    Hidden parts and tags that never end stay as they are.  Each end is looked for from where
    the last one was found, and not again once there is none, so the time is in
    proportion to the page.
    """
    parts, at, open_ended = [], 0, set()
    for m in _HIDDEN.finditer(page):
        name = m.group(1) and m.group(1).lower()
        if m.start() < at or name in open_ended:
            continue
        end = _HIDDEN_END[name].search(page, m.end())
        if end is None:
            open_ended.add(name)
            continue
        parts += [page[at:m.start()], " "]
        at = end.end()
    shown = "".join(parts) + page[at:]
    last = shown.rfind(">") + 1
    return entities.unescape(_TAG.sub(" ", shown[:last]) + shown[last:])


def slots(text: str) -> np.ndarray:
    """The slot of each byte trigram of the lower-cased text, digits and white space evened out."""
    raw = re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+", b" ", text.lower().encode())
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)
    return (h ^ (h >> np.uint32(15))) & np.uint32(SLOTS - 1)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # languages x slots

    def log_likelihood(self, text: str) -> np.ndarray:
        """Log likelihood of each language, tempered; zeros where the text has no letters."""
        s = slots(text)
        n = s.size
        if n <= 2:
            return np.zeros(len(self.languages))
        total = np.zeros(len(self.languages))
        for at in range(0, n, 1 << 20):
            total += self.log_p[:, s[at:at + (1 << 20)]].sum(axis=1, dtype=np.float64)
        return total * min(1.0, EVIDENCE / n)


def train(rows: list[tuple[str, str]]) -> Model:
    """A model from ``(text, language)`` rows; at least one language is needed."""
    languages = sorted({y for _, y in rows})
    if not languages:
        raise ValueError("no labelled text to learn languages from")
    counts = np.full((len(languages), SLOTS), 0.1)
    for text, y in rows:
        counts[languages.index(y)] += np.bincount(slots(text), minlength=SLOTS)
    return Model(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = ROWS_PER_LANGUAGE, chars: int = TRAIN_CHARS) -> Model:
    """The model of a bounded sample of labelled documents; null labels and texts are left out.

    A text that does not fit into what is left of ``chars`` is left out alone.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(id_col, F.xxhash64(text_col)).alias("h"), F.col(lang_col).alias("y"), F.col(text_col).alias("t"))
    # the smallest hashes per language: found on slim rows, a bounded number of which go on
    first = Window.partitionBy("y").orderBy("h")
    keep = rows.select("h", "y", F.length("t").alias("n")).withColumn("k", F.row_number().over(first)).filter(F.col("k") <= per_language)
    once = {r.h: (r.y, r.h, r.n) for r in sorted(keep.select("h", "y", "n").collect(), reverse=True)}
    fits = docs.sparkSession.createDataFrame(by_turns(list(once.values()), chars), "y string, h long")
    some = rows.join(F.broadcast(fits), ["h", "y"]).dropDuplicates(["h"])
    return train([(r.t, r.y) for r in some.select("t", "y").collect()])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def domain_of(host: Column) -> Column:
    """The last two names of a host."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def declared_in(page: Column) -> Column:
    """The primary language tag of the page's html element, or an empty string."""
    return F.lower(F.regexp_extract(page, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})\b""", 1))


def text_evidence(pages: DataFrame, model: Model, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(id, host, domain, suffix, declared, ll)``: a narrow pass; ``ll`` is the text's log likelihood by language."""
    spark = pages.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    host = host_of(F.col(url_col))
    p = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), domain_of(host).alias("domain"), suffix_of(host).alias("suffix"),
                     declared_in(text_or_empty(html_col)).alias("declared"), text_or_empty(html_col).alias("page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            ll = [model.log_likelihood(visible(x.as_py())) for x in batch.column(5)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(ll, pa.list_(pa.float64()))],
                                             names=["id", "host", "domain", "suffix", "declared", "ll"])
    return p.mapInArrow(run, "id long, host string, domain string, suffix string, declared string, ll array<double>")


def _softmax(x: Column) -> Column:
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
    return F.transform(e, lambda v: v / total)


def _counts(rows: DataFrame, keys: list[str], n: int, what: str = "post") -> DataFrame:
    """Sums of an array column by key, element by element (sums combine before the shuffle)."""
    sums = rows.groupBy(*keys).agg(*[F.sum(F.get(what, F.lit(i))).alias(f"s{i}") for i in range(n)])
    return sums.select(*keys, F.array(*[f"s{i}" for i in range(n)]).alias("count"))


def _less(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.greatest(x - y, F.lit(0.0)))


def _smoothed(count: Column, wider: Column) -> Column:
    """Shares of a level's counts, drawn towards the wider level's shares."""
    total = F.aggregate(count, F.lit(0.0), lambda a, v: a + v)
    return F.zip_with(count, wider, lambda c, w: (c + SMOOTH * w) / (total + SMOOTH))


def identify(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id, lang, probability, text_lang, declared, host``.

    ``lang`` has the largest posterior (the first by name among equals), ``text_lang`` the
    largest text likelihood (null for a page without letters).  Null and empty pages and
    addresses are no evidence; pages without a host share no prior.  Repeated rows give
    repeated results, null ids stay null, further columns are ignored, and an empty table gives no rows.
    """
    n = len(model.languages)
    names = F.array(*map(F.lit, model.languages))
    even = F.array(*[F.lit(1.0 / n)] * n)
    seen = text_evidence(pages, model, id_col, url_col, html_col)
    rows = cut(seen.withColumn("post", F.when(F.array_max("ll") < 0, _softmax(F.col("ll"))).otherwise(F.array(*[F.lit(0.0)] * n))))
    # counts by host, and from those by domain, by suffix and overall
    host = cut(_counts(rows, ["host", "domain", "suffix"], n))
    domain = _counts(host, ["domain", "suffix"], n, "count")
    suffix = _counts(domain, ["suffix"], n, "count")
    said = _counts(rows, ["declared"], n)
    every = _counts(suffix.withColumn("all", F.lit(1)), ["all"], n, "count").first()
    all_counts = F.array(*[F.lit(float(x or 0.0)) for x in (every["count"] if every else [0.0] * n)])
    table = (host.withColumnRenamed("count", "by_host").join(domain.withColumnRenamed("count", "by_domain"), ["domain", "suffix"])
             .join(suffix.withColumnRenamed("count", "by_suffix"), "suffix").select("host", "by_host", "by_domain", "by_suffix"))
    both = rows.join(table, "host").join(said.withColumnRenamed("count", "by_said"), "declared")
    own = F.col("post")
    overall = _smoothed(_less(all_counts, own), even)
    s = both.withColumn("p0", overall)
    s = s.withColumn("p1", _smoothed(_less(F.col("by_suffix"), own), F.col("p0")))
    s = s.withColumn("p2", _smoothed(_less(F.col("by_domain"), own), F.col("p1")))
    s = s.withColumn("prior", F.when(F.col("host") == "", F.col("p0")).otherwise(_smoothed(_less(F.col("by_host"), own), F.col("p2"))))
    # P(declared | language) from the same counts; declaring nothing tells nothing
    tells = F.zip_with(_less(F.col("by_said"), own), _less(all_counts, own), lambda c, a: (c + EVEN / n) / (a + EVEN))
    # a declaration that is itself one of the languages is believed to some degree before it is counted
    belief = F.transform(names, lambda x: F.when(x == F.col("declared"), F.lit(1.0)).otherwise(F.lit(0.05)))
    tells = F.when(F.col("declared") == "", even).otherwise(F.zip_with(tells, belief, lambda a, b: a * b))
    post = _softmax(F.zip_with(F.zip_with(F.transform("prior", lambda v: F.log(v)), F.transform(tells, lambda v: F.log(v)), lambda a, b: a + b), F.col("ll"), lambda a, b: a + b))
    s = s.withColumn("fused", post)
    at = F.array_position("fused", F.array_max("fused")).cast("int")
    text_at = F.array_position("ll", F.array_max("ll")).cast("int")
    return s.select("id", F.get(names, at - 1).alias("lang"), F.array_max("fused").alias("probability"),
                    F.when(F.array_max("ll") < 0, F.get(names, text_at - 1)).alias("text_lang"), "declared", "host")
