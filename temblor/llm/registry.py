"""The checked queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from temblor.llm.decontamination import OP1_SQL, op1_decontamination
from temblor.llm.licenses import OP10_SQL, op10_licenses
from temblor.llm.middle import OP11_SQL, op11_middle
from temblor.llm.ngrams import op5_language_model
from temblor.llm.packing import op2_packing
from temblor.llm.pii import op9_pii
from temblor.llm.quality import op6_quality
from temblor.llm.quotes import op4_quotations
from temblor.llm.repeats import op8_repeats
from temblor.llm.simhash import op7_simhash
from temblor.llm.token_files import op3_token_files
from temblor.llm.toxicity import op12_toxicity
from temblor.llm.variants import OP13_SQL, op13_variants

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_token_files": op3_token_files,
    "op4_quotations": op4_quotations,
    "op5_language_model": op5_language_model,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_repeats": op8_repeats,
    "op9_pii": op9_pii,
    "op10_licenses": op10_licenses,
    "op11_middle": op11_middle,
    "op12_toxicity": op12_toxicity,
    "op13_variants": op13_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op10_licenses": OP10_SQL,
    "op11_middle": OP11_SQL,
    "op13_variants": OP13_SQL,
}
