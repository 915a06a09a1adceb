"""Language identification by compression.

Each language has a raw-content dictionary: text of labelled documents in that language. A
text is compressed once with every dictionary, and the smallest result names its language. How
much smaller it is than the runner-up is the margin; narrow margins are rejected.
"""

from __future__ import annotations

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import remainder, table
from weftline.session import prepare

LETTER = regex.compile(r"\p{L}")
#: ASCII characters other than letters count as spaces.
PLAIN = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
UND = "und"
HELD_OUT = (4, 2)
#: Compression parameters: short matches count, as texts may be a few words long.
LEVEL = {"strategy": zstandard.STRATEGY_LAZY, "min_match": 3, "window_log": 20, "hash_log": 17, "chain_log": 17, "search_log": 4, "target_length": 16}


def labelled_sample(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", held_out: Column | None = None, dict_bytes: int = 110_000, most_langs: int = 500) -> dict[str, list[str]]:
    """Texts to make dictionaries of, by language: a bounded sample of the rows that aren't held
    out, drawn by a hash of the id, with about twice ``dict_bytes`` characters per language.

    The language with the most text comes first. More than ``most_langs`` distinct languages are an error, as the dictionaries must fit the
    driver and each worker.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(doc_id).alias("id"), F.col(text).alias("text"), (held_out if held_out is not None else F.lit(False)).alias("held")).where("not held and lang is not null and text is not null and text <> ''")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.sum(F.length("text").cast("long")).alias("n")).limit(most_langs + 1).collect()}
    if len(sizes) > most_langs:
        raise ValueError(f"more than {most_langs} languages")
    if not sizes:
        return {}
    at = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    share = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, 2.0 * dict_bytes / n + 1e-9)))]), F.col("lang"))
    out: dict[str, list[tuple]] = {k: [] for k in sizes}
    # a text longer than a dictionary can't fill more than all of it
    for r in rows.where(at < share).select("lang", at.alias("at"), F.substring("text", 1, dict_bytes).alias("text")).collect():
        out[r.lang].append((r.at, r.text))
    for k, got in out.items():
        if not got:  # a language of few long texts may draw none: its first row by the hash
            r = rows.where(F.col("lang") == k).orderBy(at, "text").select(F.substring("text", 1, dict_bytes)).first()
            got.append((0.0, r[0]))
    return {k: [t for _, t in sorted(out[k])] for k in sorted(sizes, key=lambda k: (-sizes[k], k))}


def plain(text: str) -> bytes:
    """Lower-cased words between single spaces, without ASCII digits and punctuation."""
    return b" ".join(text.lower().encode().translate(PLAIN).split())


class Model:
    """A compressor for each language; made of texts by language."""

    def __init__(self, texts: dict[str, list[str]], dict_bytes: int = 110_000, narrow: float = 0.01) -> None:
        """Ties go to the language that ``texts`` has first."""
        self.langs = list(texts)
        self.narrow = narrow
        # the end of a dictionary is the cheapest to refer to and the start goes first
        self.raw = {k: plain(" ".join(dict.fromkeys(texts[k])))[:dict_bytes] for k in self.langs}
        self._made: list = []

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": []}

    def compressors(self) -> list:
        if not self._made:
            for k in self.langs:
                params = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, **LEVEL)
                d = zstandard.ZstdCompressionDict(self.raw[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=params)
                self._made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        return self._made

    def sizes(self, text: str) -> list[int]:
        data = plain(text)
        return [len(c.compress(data)) for c in self.compressors()]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, accepted). Texts without a letter are ``und``, with score 0.

        With the smallest size s and the runner-up's r, the margin is (r - s) / r, and the score
        rises with it from 0.5 towards 1, at the least margin that is accepted to 0.75.
        """
        if not text or not self.langs or not LETTER.search(text):
            return UND, 0.0, False
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0, True
        s, r = sizes[order[0]], sizes[order[1]]
        margin = (r - s) / r
        return self.langs[order[0]], 1 - 0.5 * 2 ** (-margin / self.narrow), margin >= self.narrow


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and accepted (the margin isn't narrow); these take the place
    of columns of those names. Null, empty and letterless texts are ``und``. Whole texts are
    compressed, whatever their length. Rows that repeat are treated alike."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages x dict_bytes
    new = ["lang_pred", "score", "accepted"]
    kept = [c for c in docs.columns if c not in new]

    def run(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t.as_py()) for t in b.columns[-1]]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array([f[i] for f in found], k) for i, k in enumerate(kinds))], [*kept, *new])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

    schema = StructType([docs.schema[c] for c in kept]).add("lang_pred", StringType()).add("score", DoubleType()).add("accepted", BooleanType())
    return docs.select(*kept, docs[text].alias("__text")).mapInArrow(run, schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    model = Model(labelled_sample(docs, held_out=held))
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score", "accepted")
