"""Language identification by compression: the language whose text, as a zstandard dictionary, leaves a document smallest."""

from __future__ import annotations

from dataclasses import dataclass

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.llm import common

LETTER = regex.compile(r"\p{L}")
SIGNS = bytes(b for b in range(0x80) if not chr(b).isalpha())
PLAIN = bytes.maketrans(SIGNS, b" " * len(SIGNS))


def letters(text: str) -> bytes:
    """The text as compared: lower case, signs and digits of ASCII as single blanks."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(PLAIN).split()) + b" "


@dataclass(frozen=True)
class Languages:
    """One raw-content dictionary per language, and how texts are measured against them."""

    dictionaries: dict[str, bytes]
    block: int = 512
    margin: float = 0.002

    def compressors(self):
        import zstandard as z

        how = z.ZstdCompressionParameters(
            window_log=19, hash_log=17, chain_log=17, search_log=4, min_match=4, strategy=z.STRATEGY_GREEDY,
            write_content_size=False, write_dict_id=False, write_checksum=False,
        )
        made = {}
        for lang, raw in sorted(self.dictionaries.items()):
            content = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=how)
            made[lang] = z.ZstdCompressor(dict_data=content, compression_params=how)
        return made

    def classify(self, text: str | None, compressors) -> tuple[str, float, bool]:
        """(language, score, accepted); every block of the whole text is encoded by itself with every dictionary."""
        if not text or not compressors or not LETTER.search(text):
            return "und", 0.0, False
        plain = letters(text)
        sizes = sorted((sum(len(c.compress(plain[at : at + self.block])) for at in range(0, len(plain), self.block)), lang) for lang, c in compressors.items())
        best, lang = sizes[0]
        # a byte less counts as two bits of evidence
        score = 1 / sum(2.0 ** max(-1000, 2 * (best - size)) for size, _ in sizes)
        return lang, score, len(sizes) == 1 or (sizes[1][0] - best) > self.margin * best


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", train: Column | None = None, dictionary_bytes: int = 262_144, excerpt: int = 240, **how) -> Languages:
    """Dictionaries from a bounded sample: per language, excerpts of ``excerpt`` characters out of documents chosen by a hash of their
    text, up to ``dictionary_bytes``; copies of a text count once. Rows without language or text are left out; ``train`` restricts the
    rows further."""
    rows = docs.filter(F.col(lang).isNotNull() & (F.length(text) > 0))
    rows = rows.filter(train) if train is not None else rows
    wanted = 2 * dictionary_bytes // excerpt
    texts = rows.select(F.col(lang).alias("lang"), F.xxhash64(text)).distinct()
    counts = {r[0]: r[1] for r in texts.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return Languages({}, **how)
    limits = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 1.3 * wanted / n)))])
    order = F.pmod(F.xxhash64(text), F.lit(1 << 30))
    start = F.floor(F.length(text) / 3).cast("int") + 1
    sample = rows.select(F.col(lang).alias("lang"), order.alias("order"), F.substring(F.col(text), start, F.lit(excerpt)).alias("text"))
    sample = sample.filter(F.col("order") < F.element_at(limits, F.col("lang")) * F.lit(1 << 30)).distinct().collect()
    parts: dict[str, dict[bytes, None]] = {}
    for r in sorted(sample, key=lambda r: (r["lang"], r["order"], r["text"])):
        if LETTER.search(r["text"]):
            parts.setdefault(r["lang"], {})[letters(r["text"])] = None
    return Languages({k: b"".join(v)[:dictionary_bytes] for k, v in parts.items()}, **how)


def identify(docs: DataFrame, languages: Languages, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and accepted, for whole texts of any length.

    Null texts and texts without a letter are ``und`` with score 0 and not accepted, as is every text if nothing was learned. Other
    texts get the language with the smallest encoding, the first by name in a tie; they are accepted if the next one is larger by
    more than ``margin`` of the size. Input columns of the three names, in whatever case, are replaced; all others, repeated rows and null ids pass.
    """
    import pyarrow as pa

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "accepted")]
    at = kept.index(text)

    def run(batches):
        compressors = languages.compressors()
        for batch in batches:
            found = [languages.classify(t, compressors) for t in batch.column(at).to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "lang_pred", "score", "accepted"])

    plain = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*plain.schema.fields]).add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return plain.mapInArrow(run, schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """Every document, by dictionaries of the documents outside of the held-out quarter."""
    docs = common.table(spark, sf_dir, "documents")
    fold = common.fold(F.col("doc_id"), 4)
    languages = learn(docs, train=fold != 2)
    found = identify(docs.select("doc_id", (fold == 2).alias("held_out"), "text"), languages)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")
