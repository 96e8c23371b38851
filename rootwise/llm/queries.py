"""The registered corpus queries: each operator over its whole table."""

from __future__ import annotations

from corpus_pipeline import ORACLE_SQL, run
from rootwise.llm.common import table
from rootwise.llm.conversations import conversation_repairs, damaged
from rootwise.llm.decontaminate import contamination
from rootwise.llm.exact_dedup import exact_groups
from rootwise.llm.jaccard_join import near_groups
from rootwise.llm.language import languages
from rootwise.llm.licenses import license_scan
from rootwise.llm.lines import line_dedup
from rootwise.llm.lm_scoring import lm_scores
from rootwise.llm.oracles import OPERATOR_ORACLES
from rootwise.llm.packing import packed, public_vocabulary
from rootwise.llm.phrases import collocations
from rootwise.llm.quality import quality_scores
from rootwise.llm.sharding import balanced_shards
from rootwise.llm.warc import archived_and_read

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]


def op1_decontaminate(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, folder, "benchmark"), keep_text=False)


def op2_license_scan(spark, folder):
    return license_scan(table(spark, folder, "documents"))


def op3_jaccard_join(spark, folder):
    groups = near_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


def op4_balanced_shards(spark, folder):
    return balanced_shards(table(spark, folder, "documents"), n_shards=40)


def op5_packing(spark, folder):
    return packed(table(spark, folder, "documents"), **public_vocabulary())


def op6_quality(spark, folder):
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_warc(spark, folder):
    return archived_and_read(table(spark, folder, "pages"))


def op8_lm_scoring(spark, folder):
    return lm_scores(table(spark, folder, "documents"))


def op9_exact_dedup(spark, folder):
    return exact_groups(table(spark, folder, "documents"))


def op10_language(spark, folder):
    return languages(table(spark, folder, "documents"))


def op11_conversation_repair(spark, folder):
    return conversation_repairs(damaged(table(spark, folder, "conversations")))


def op12_line_dedup(spark, folder):
    return line_dedup(table(spark, folder, "documents"))


def op13_collocations(spark, folder):
    return collocations(table(spark, folder, "documents"))


def pipeline(spark, folder):
    return run(spark, folder)


LLM_QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_license_scan": op2_license_scan,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_balanced_shards": op4_balanced_shards,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_warc": op7_warc,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_language": op10_language,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_line_dedup": op12_line_dedup,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

LLM_ORACLES = dict(OPERATOR_ORACLES) | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
