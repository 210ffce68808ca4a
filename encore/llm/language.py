"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of excerpts of its
training texts. A text is encoded with every dictionary, and the language
whose encoding is smallest wins: its dictionary shares most with the text. A
text is compressed whole, in pieces of ``piece_bytes``, so that a long text's
own repetitions do not drown the dictionary.

Code length of a language = compressed bytes + log2(1/share of the language in
training)/8, the cost of naming it; the second term only breaks ties of very
short texts. ``score`` = 1 - 2^-(bytes by which the second best is longer).
A prediction is rejected when that margin is under ``min_margin`` of the
second-best length, or when the compressed bytes alone, without the naming
cost, are less than ``min_bytes`` apart. ``fit`` learns ``min_margin``: half the
0.5 % quantile of the margins that dictionaries of every other excerpt give
the remaining excerpts, where they are named rightly.

Defined cases: null, empty and letterless texts are ``und`` with score 0, and
rejected; languages learnt from nothing do not exist, so with an empty
training table every text is ``und``; a single learnt language is compared with
a compressor without a dictionary, and where that is as good the text is
rejected; a null language teaches nothing;
repeated rows count as often as they occur; other columns are untouched, also
where their names clash with the result's.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from encore.llm.common import free_name, id_text, unit_hash

UNDETERMINED = "und"
RESULT = "lang string, score double, margin double, rejected boolean"
#: At most about so many held-out texts set the margin (four a language at least).
CALIBRATION_TEXTS = 2000
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str) -> str:
    """Lower case, every run of other characters than word letters one space."""
    return " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "


@dataclass(frozen=True)
class LanguageModel:
    """``languages`` in descending share, a dictionary and a naming cost (bytes) for each."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    naming_bytes: tuple[float, ...]
    piece_bytes: int = 4096
    min_margin: float = 0.0005
    min_bytes: float = 1.0


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        dictionary_bytes: int = 65536, excerpts: int = 200, excerpt_chars: int = 2000,
        max_languages: int = 512, piece_bytes: int = 4096, min_margin: float | None = None, seed: int = 17) -> LanguageModel:
    """Learn the dictionaries of ``train``'s languages.

    Language shares count all rows. A dictionary is the last
    ``dictionary_bytes`` of at most ``excerpts`` excerpts of ``excerpt_chars``
    characters, from rows drawn by a hash of id and text. More than
    ``max_languages`` languages are an error: the model, at most
    ``max_languages * dictionary_bytes``, is sent to every task. A
    ``min_margin`` of None is learnt (see the module).
    """
    default = LanguageModel.min_margin if min_margin is None else min_margin
    known = train.where(F.col(lang_col).isNotNull())
    counts = known.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"over {max_languages} languages; raise max_languages if the model may be that large")
    if not counts:
        return LanguageModel((), (), (), piece_bytes, default)
    total = sum(r["count"] for r in counts)
    # About twice the wanted rows of each language pass the hash filter, so a language's rows never meet in one task.
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, 2.0 * excerpts / r["count"]))])
    length = F.length(text_col)
    start = F.floor(unit_hash(seed + 1, id_text(id_col), F.col(text_col)) * (F.greatest(length - excerpt_chars, F.lit(0)) + 1)).cast("int")
    picked = (known.select(F.col(lang_col).alias("lang"), unit_hash(seed, id_text(id_col), F.length(text_col)).alias("u"),
                           F.coalesce(F.substring(F.col(text_col), start + 1, F.lit(excerpt_chars)), F.lit("")).alias("excerpt"))
              .where(F.col("u") < F.element_at(share, F.col("lang")))
              .withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("u", "excerpt")))
              .where(F.col("n") <= excerpts).orderBy("lang", "n").collect())
    joined: dict[str, list[str]] = {}
    for r in picked:
        joined.setdefault(r["lang"], []).append(normalise(r["excerpt"]))
    languages = tuple(r["lang"] for r in counts)
    naming = tuple(-math.log2(r["count"] / total) / 8 for r in counts)

    def dictionaries(first: int, step: int) -> tuple[bytes, ...]:
        return tuple("".join(joined.get(lang, [])[first::step]).encode()[-dictionary_bytes:] for lang in languages)

    model = LanguageModel(languages, dictionaries(0, 1), naming, piece_bytes, default)
    if min_margin is not None:
        return model
    return replace(model, min_margin=_learnt_margin(replace(model, dictionaries=dictionaries(0, 2), min_margin=0.0),
                                                    {lang: texts[1::2] for lang, texts in joined.items()}, default))


def _learnt_margin(model: LanguageModel, held_out: dict[str, list[str]], default: float) -> float:
    """Half the 0.5 % quantile of the margins of held-out texts that are named rightly and not by a tie; the default if under 20."""
    coder, each = Coder(model), max(4, CALIBRATION_TEXTS // len(model.languages))
    found = [(lang, coder.predict(t)) for lang, texts in held_out.items() for t in texts[:each]]
    margins = sorted(margin for lang, (named, _, margin, rejected) in found if named == lang and not rejected)
    return margins[len(margins) // 200] / 2 if len(margins) >= 20 else default


class Coder:
    """The compressors of a model, one for each language, in a task."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.compressors = []
        # A single language is held against none: a compressor without a dictionary, which is never named.
        rival = (b"",) if len(model.languages) == 1 else ()
        self.naming = model.naming_bytes + (0.0,) * len(rival)
        for content in model.dictionaries + rival:
            # Greedy search for matches from 3 bytes on: word pieces of a few letters tell languages apart.
            params = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_GREEDY, min_match=3, window_log=17, hash_log=16, chain_log=16, search_log=4,
                write_content_size=0, write_checksum=0, write_dict_id=0)
            dictionary = None
            if content:
                dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(compression_params=params)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params))

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected) of one text."""
        plain = normalise(text or "")
        if not self.compressors or not any(c.isalpha() for c in plain):
            return UNDETERMINED, 0.0, 0.0, True
        data, step = plain.encode("utf-8", "surrogatepass"), self.model.piece_bytes
        pieces = [data[i:i + step] for i in range(0, len(data), step)]
        raw = [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]
        lengths = [size + n for size, n in zip(raw, self.naming)]
        order = sorted(range(len(lengths)), key=lambda i: (lengths[i], i))
        best, second = lengths[order[0]], lengths[order[1]]
        margin = (second - best) / second
        if order[0] == len(self.model.languages):
            return self.model.languages[0], 0.0, -margin, True
        tie = raw[order[1]] - raw[order[0]] < self.model.min_bytes
        return self.model.languages[order[0]], 1.0 - 2.0 ** -min(second - best, 1000.0), margin, tie or margin < self.model.min_margin


def identify(spark: SparkSession, model: LanguageModel, text_col: str = "text") -> Column:
    """A column expression: struct of lang, score, margin and rejected for a text column."""
    shared = spark.sparkContext.broadcast(asdict(model))

    def predict(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Coder(LanguageModel(**shared.value))
        for texts in arrays:
            found = list(zip(*[coder.predict(t.as_py()) for t in texts])) or [()] * 4
            yield pa.StructArray.from_arrays(
                [pa.array(v, t) for v, t in zip(found, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))],
                names=["lang", "score", "margin", "rejected"])

    udf = F.arrow_udf(predict, RESULT).asNondeterministic()  # evaluated once, where it stands
    return udf(F.col(text_col))


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose language is rejected; same columns."""
    name = free_name(docs, "language")
    return docs.withColumn(name, identify(docs.sparkSession, model, text_col)).where(~F.col(name)["rejected"]).drop(name)
