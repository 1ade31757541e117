"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from estatelens.llm import (collocations, decontaminate, html_text, jaccard, licenses, linededup, mixing, quality, simhash,
                            suffixdedup, tokenalign, tokenfiles, toxicity)


def queries() -> dict[str, Callable]:
    return {
        "op1_suffix_dedup": suffixdedup.op1,
        "op2_license_scan": licenses.op2,
        "op3_decontaminate": decontaminate.op3,
        "op4_simhash_golay": simhash.op4,
        "op5_quality_rules": quality.op5,
        "op6_html_text": html_text.op6,
        "op7_source_mix": mixing.op7,
        "op8_toxicity": toxicity.op8,
        "op9_line_dedup": linededup.op9,
        "op10_token_planes": tokenfiles.op10,
        "op11_jaccard_join": jaccard.op11,
        "op12_phrase_mining": collocations.op12,
        "op13_token_alignment": tokenalign.op13,
    }


def oracle_sql() -> dict[str, str]:
    """Fingerprints, suffix spans, votes, random transfers, models, pages, tokens and token files are not SQL."""
    return {"op5_quality_rules": quality.SQL, "op9_line_dedup": linededup.SQL, "op11_jaccard_join": jaccard.SQL,
            "op12_phrase_mining": collocations.SQL}
