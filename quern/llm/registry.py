"""Registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from quern.llm.ann import op7_ann_forest
from quern.llm.bpe import op3_bpe_tokens
from quern.llm.manifest import OP12_SQL, op12_merkle_manifest
from quern.llm.merkle import op9_merkle_fingerprints
from quern.llm.mixing import OP4_SQL, op4_mix_sources
from quern.llm.packing import op13_best_fit_packing
from quern.llm.pii import op6_pii_surrogates
from quern.llm.quality import op1_quality_fm
from quern.llm.simhash import op8_simhash_near_dedup
from quern.llm.token_files import op10_token_files
from quern.llm.toxicity import op5_toxicity_nnpu
from quern.llm.warc import op2_warc_roundtrip
from quern.llm.whitening import op11_polar_whitening

QUERIES = {f.__name__: f for f in (
    op1_quality_fm, op2_warc_roundtrip, op3_bpe_tokens, op4_mix_sources, op5_toxicity_nnpu, op6_pii_surrogates,
    op7_ann_forest, op8_simhash_near_dedup, op9_merkle_fingerprints, op10_token_files,
    op11_polar_whitening, op12_merkle_manifest, op13_best_fit_packing)}
ORACLE_SQL = {"op4_mix_sources": OP4_SQL, "op12_merkle_manifest": OP12_SQL}
