"""The corpus pipeline: documents to packed training sequences, each stage by an operator of ``tsengine.llm``."""

from tsengine.llm import exact, jaccard, mixture, packing, quality, queries
from tsengine.session import materialize, shipped


def good_quality(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, queries.table(spark, sf_dir, "labels"))


def without_copies(spark, docs, sf_dir):
    """One document of each group of equal texts, in the order of ids: the next stage sends packets by ranges of ids, which are few
    and large if each task holds a range."""
    return exact.drop_equal_texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")


def without_near_copies(spark, docs, sf_dir):
    """One document of each group that links of similar shingle sets join."""
    return jaccard.one_of_each(docs)


def mixed(spark, docs, sf_dir):
    """Documents drawn to the target weights; one drawn in two epochs comes twice."""
    return mixture.mix_sources(docs, queries.MIXTURE, queries.source_domain()).select("row.*")


def packed(spark, docs, sf_dir):
    """The drawn documents as pieces in sequences."""
    return packing.pack_documents(docs, queries.vocabulary())


STAGES = [
    ("quality classifier", shipped(good_quality)),
    ("exact dedup", shipped(without_copies)),
    ("n-gram Jaccard join", shipped(without_near_copies)),
    ("mixing sources", shipped(mixed)),
    ("best-fit packing", shipped(packed)),
]

#: A trained classifier and a tokenizer are not SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def steps(spark, sf_dir):
    """``(name, result)`` of each stage; all but the last are written and read back, so no stage works out an earlier one again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, "stage")
        yield name, docs


def run(spark, sf_dir):
    """Pieces of the packed sequences made from ``documents``.

    Texts that are null or empty are scored, compared and packed as empty ones. Of equal texts the smallest id stays, of rows that repeat an id
    and a text one; a null id stays only where its text has no other. Extra columns are carried along. An empty table gives no piece.
    """
    *_, (_, docs) = steps(spark, sf_dir)
    return docs
