"""The stages of the corpus pipeline.

Each takes the session, the documents that the stage before kept, and the folder of the
input tables. All but the last return the columns of documents, whatever they are called
beside doc_id, text, lang, source and n_chars. Rows are judged one by one, so repeated
ones are treated alike, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.llm import decontamination, language, mixing, ngram_join, pii
from wardbook.llm.tables import packed, unpacked

#: A language less likely than this many times chance is no language; 0.3 of four languages,
#: and no more than that of fewer.
LEAST_OF_CHANCE, LEAST_LANGUAGE_SCORE = 1.2, 0.3
#: The key of the surrogates; a production run sets its own in this session setting.
KEY_SETTING, DEFAULT_KEY = "wardbook.pii.key", "pipeline"


def _aside(docs: DataFrame) -> DataFrame:
    """text, and the other columns as one, which no operator's own columns clash with."""
    return docs.select(packed([c for c in docs.columns if c != "text"]), "text")


def _back(done: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of docs again, text and these anew."""
    new = {"text": F.col("text")} | new
    return done.select(*[new[c].alias(c) if c in new else unpacked([c])[0] for c in columns])


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network, trained on docs' own labels, recognises.

    Rejected: texts that are null or have no letter, and those of which no language is
    likely over the whole text, as when nearly all learned languages share it evenly. If no
    row has both text and lang, no language is learned, and all texts with a letter stay.
    """
    model = language.trained(docs.select("doc_id", "text", "lang"))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language.identified(_aside(docs), model, keep_text=True)
    least = min(LEAST_LANGUAGE_SCORE, LEAST_OF_CHANCE / len(model.languages))
    kept = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= least)
    return _back(judged.where(kept), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one of the lowest doc_id."""
    return ngram_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    clean = decontamination.decontaminated(_aside(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _back(clean, docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the text."""
    done = pii.pseudonymised(_aside(docs), spark.conf.get(KEY_SETTING, DEFAULT_KEY))
    return _back(done, docs.columns, n_chars=F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: doc_id, source, size, source_size, target and taken of the documents it takes."""
    taken = mixing.mixed(docs.select("doc_id", "text", "source")).where("taken > 0")
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language", keep_languages),
    ("near copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("personal data", replace_personal_data),
    ("mixing", mix),
]
