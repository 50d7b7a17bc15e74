"""A cleaning pipeline over ``documents``: each stage's rows are written and are the next one's input."""

from __future__ import annotations

import public_tokenizers

from docloom.llm import bpe, decontaminate, lines, quality, simhash
from docloom.llm.common import discard, release, saved, table, written


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or the perplexity bands reject go."""
    return quality.keep_good(docs)


def line_dedup(spark, docs, sf_dir):
    """Of each component of alike lines one stays; documents that keep no line go."""
    return lines.drop_lines(docs)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of documents that are alike (five-word shingles, similarity 0.8) the one with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a window of the benchmark lose the words of it; those with no other words go."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark, docs, sf_dir):
    """Token counts and digests of the ids and of the decoded text of what is left."""
    return bpe.round_trip_report(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", tokenise),
]

#: SQL expresses neither the model of the first stage nor the encoding; tests hold the pipeline against its parts by brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        before, began = docs, written()
        docs = saved(step(spark, docs, sf_dir))
        release(began, written() - 1)  # what the stage wrote for itself
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
