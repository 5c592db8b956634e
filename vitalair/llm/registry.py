"""Queries of this subpackage: name -> callable(spark, sf_dir), and SQL where SQL can express one."""

from __future__ import annotations

from vitalair.llm import q02_licences, q11_variants, q12_resampling, q13_exact_dedup
from vitalair.llm.q01_fingerprints import op1_fingerprints
from vitalair.llm.q02_licences import op2_licences
from vitalair.llm.q03_packing import op3_packing
from vitalair.llm.q04_line_dedup import op4_line_dedup
from vitalair.llm.q05_chats import op5_chats
from vitalair.llm.q06_simhash import op6_simhash
from vitalair.llm.q07_quality import op7_quality
from vitalair.llm.q08_decontamination import op8_decontamination
from vitalair.llm.q09_urls import op9_urls
from vitalair.llm.q10_extraction import op10_extraction
from vitalair.llm.q11_variants import op11_variants
from vitalair.llm.q12_resampling import op12_resampling
from vitalair.llm.q13_exact_dedup import op13_exact_dedup

QUERIES = [op1_fingerprints, op2_licences, op3_packing, op4_line_dedup, op5_chats, op6_simhash, op7_quality, op8_decontamination, op9_urls, op10_extraction, op11_variants, op12_resampling, op13_exact_dedup]


def queries():
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op2_licences": q02_licences.SQL, "op11_variants": q11_variants.SQL, "op12_resampling": q12_resampling.SQL, "op13_exact_dedup": q13_exact_dedup.SQL}
