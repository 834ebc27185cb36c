"""The queries of this subpackage, and the SQL of those that SQL can express."""

from . import chat, decontaminate, licenses, line_templates, mixing, near_dup, permutation_index, personal_data, ppm, sharding, toxicity, vector_codes, whitening

QUERIES = {
    "op1_chat_formatting": chat.query,
    "op2_byte_ppm": ppm.query,
    "op3_line_templates": line_templates.query,
    "op4_minhash_near_dup": near_dup.query,
    "op5_benchmark_decontamination": decontaminate.query,
    "op6_license_scan": licenses.query,
    "op7_source_mixing": mixing.query,
    "op8_permutation_index": permutation_index.query,
    "op10_weak_supervision_toxicity": toxicity.query,
    "op9_sampled_splitters": sharding.query,
    "op11_member_resident_codes": vector_codes.query,
    "op12_personal_data_anchors": personal_data.query,
    "op13_chebyshev_whitening": whitening.query,
}
SQL = {
    "op1_chat_formatting": chat.SQL,
    "op5_benchmark_decontamination": decontaminate.SQL,
    "op7_source_mixing": mixing.SQL,
    "op11_member_resident_codes": vector_codes.SQL,
}
