"""The queries of this subpackage, and SQL for those that SQL can express."""

from . import (collocations, decontaminate, exact_dedup, lexical, licenses, mixing, pieces, quality, secrets, sharding,
               simhash, token_store, toxicity)

QUERIES = {f.__name__: f for f in (
    sharding.op1_jump_sharding, licenses.op2_sentence_licenses, toxicity.op3_gru_toxicity,
    secrets.op4_markov_secrets, exact_dedup.op5_exact_dedup, token_store.op6_huffman_ids, quality.op7_crf_quality,
    pieces.op8_sentencepiece, simhash.op9_simhash, decontaminate.op10_fm_decontamination,
    collocations.op11_collocations, lexical.op12_lexical_search, mixing.op13_mixing)}

ORACLES = {"op2_sentence_licenses": licenses.OP2_SQL, "op5_exact_dedup": exact_dedup.OP5_SQL,
           "op11_collocations": collocations.OP11_SQL, "op12_lexical_search": lexical.OP12_SQL,
           "op13_mixing": mixing.OP13_SQL}
