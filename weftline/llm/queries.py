"""The registered queries of this package and, where SQL can express them, their SQL."""

from weftline.llm.bpe import op2_bpe
from weftline.llm.embedding_dedup import OP5_SQL, op5_embedding_near_dedup
from weftline.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from weftline.llm.langid import op1_language_id
from weftline.llm.license_scan import OP7_SQL, op7_license_scan
from weftline.llm.lm_score import op4_lm_score
from weftline.llm.mixing import op10_mixing
from weftline.llm.pii import op3_pii
from weftline.llm.simhash import op8_simhash
from weftline.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_bpe": op2_bpe,
    "op3_pii": op3_pii,
    "op4_lm_score": op4_lm_score,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_license_scan": op7_license_scan,
    "op8_simhash_near_dedup": op8_simhash,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
}

ORACLE = {
    "op5_embedding_near_dedup": OP5_SQL,
    "op7_license_scan": OP7_SQL,
    "op9_exact_dedup": OP9_SQL,
}
