"""Language identification by compression: the language whose text helps most to compress a document.

Fitting gathers a bounded sample of labelled texts: for each of the MAX_LANGUAGES languages with the most distinct texts (ties: those that sort first) the SAMPLE_TEXTS distinct texts with the smallest hash,
SAMPLE_CHARS characters of each at most. Lower-cased and without digits and ASCII punctuation, they form that language's
zstandard raw-content dictionary, of DICTIONARY_BYTES at most.

Prediction encodes the whole text, in blocks of BLOCK_BYTES, once with each dictionary. The smallest total wins; ties go to the
language that sorts first. ``score`` is the margin (second - smallest) / second; a text is rejected when it is narrower than
``min_margin``, or has no letter.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text when nothing was
learned; with one language learned the score is 1. Rows are predicted one by one, so repeated rows get equal results. A null label or text teaches nothing.
An empty table gives an empty result. Columns named like the added ones give way.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sample_bound, sample_hash, ship, spare, with_columns

SAMPLE_TEXTS, SAMPLE_CHARS = 400, 2000
#: Languages that are learned at most: those with the most distinct texts.
MAX_LANGUAGES = 100
DICTIONARY_BYTES, BLOCK_BYTES = 100_000, 512
#: A search that follows chains, with short matches: small blocks are found in the dictionary even when they have few common words.
PARAMETERS = {"window_log": 17, "chain_log": 15, "hash_log": 16, "search_log": 4, "min_match": 4, "strategy": zstandard.STRATEGY_LAZY,
              "write_content_size": False, "write_checksum": False, "write_dict_id": False}
UNKNOWN = "und"
_DROP = (string.punctuation + string.digits).encode()


def normal(text: str) -> bytes:
    """Lower-cased UTF-8 without digits and ASCII punctuation, white space as single spaces."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(None, _DROP).split())


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary content of each language; reads a bounded sample of ``labelled``."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    rows = rows.withColumn("h", sample_hash(F.col("text")))
    # Distinct texts are counted, so that copies don't lower the bound: with SAMPLE_TEXTS distinct texts or more, as many are found.
    sizes = rows.select("lang", "h").distinct().groupBy("lang").count()
    counts = {r["lang"]: r["count"] for r in sizes.orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()}
    if not counts:
        return {}
    bound = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, sample_bound(SAMPLE_TEXTS, n))])
    low = rows.where(F.col("h") < bound[F.col("lang")]).distinct()  # none of a language that isn't learned
    ranked = low.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))
    sample = ranked.where(F.col("place") <= SAMPLE_TEXTS).select("lang", "place", F.substring("text", 1, SAMPLE_CHARS).alias("text")).collect()
    found: dict[str, list[bytes]] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], r["place"])):
        piece = normal(row["text"])
        if piece:
            found.setdefault(row["lang"], []).append(piece)
    return {lang: _fill(pieces) for lang, pieces in found.items()}


def _fill(pieces: list[bytes]) -> bytes:
    """The texts' beginnings, equally long as far as they go, up to the dictionary's size."""
    share = max(1, DICTIONARY_BYTES // len(pieces))
    rest = DICTIONARY_BYTES - sum(len(p[:share]) for p in pieces)
    out = []
    for p in pieces:
        more = min(rest, max(0, len(p) - share))
        rest -= more
        out.append(p[:share + more])
    return b" ".join(out)[:DICTIONARY_BYTES]


def encoders(model: dict[str, bytes]) -> list[tuple[str, Callable[[bytes], bytes]]]:
    out, parameters = [], zstandard.ZstdCompressionParameters(**PARAMETERS)
    for lang in sorted(model):
        content = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=parameters)
        out.append((lang, zstandard.ZstdCompressor(compression_params=parameters, dict_data=content).compress))
    return out


def classify(text: str | None, coders: list[tuple[str, Callable[[bytes], bytes]]]) -> tuple[str, float]:
    """Language and margin of a text."""
    if not text or not coders or not any(c.isalpha() for c in text):
        return UNKNOWN, 0.0
    data = b" " + normal(text) + b" "
    blocks = [data[at:at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
    sizes = sorted((sum(len(encode(b)) for b in blocks), lang) for lang, encode in coders)
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0] if sizes[1][0] else 0.0


def predictor(model: dict[str, bytes]) -> Callable:
    """A column function text -> struct(lang, score). ``model`` goes with it: a dictionary of bounded size for each language."""
    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coders = encoders(model)
        for batch in texts:
            found = [classify(x.as_py(), coders) for x in batch]
            yield pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                                             names=["lang", "score"])

    return predict


def identify(docs: DataFrame, model: dict[str, bytes], min_margin: float = 0.005, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    ship(docs.sparkSession)
    told = spare(docs, "told_language")
    out = docs.withColumn(told, predictor(model)(F.col(text_col)))
    rejected = (F.col(f"{told}.lang") == UNKNOWN) | (F.col(f"{told}.score") < min_margin)
    return with_columns(out, {"lang_pred": F.col(f"{told}.lang"), "score": F.col(f"{told}.score"), "rejected": rejected}).drop(told)
