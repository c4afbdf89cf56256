"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import importlib

#: query name -> module of this package; each has query(spark, sf_dir) and, where SQL can
#: express the result, ORACLE (text) or oracle() (a function that gives it).
OPERATORS = {
    "op1_exact_dedup": "exact_dedup",
    "op2_substring_dedup": "substring_dedup",
    "op3_secrets": "secrets",
    "op4_sharding": "sharding",
    "op5_language": "language",
    "op6_toxicity": "toxicity",
    "op7_licenses": "licenses",
    "op8_decontamination": "decontaminate",
    "op9_bpe": "bpe",
    "op10_simhash": "simhash",
    "op11_whitening": "whitening",
    "op12_byte_bpe": "byte_bpe",
    "op13_runs": "runs",
}


def _module(name: str):
    return importlib.import_module(f"panelkit.llm.{name}")


def queries() -> dict:
    return {key: _module(name).query for key, name in OPERATORS.items()}


def oracle_sql() -> dict[str, str]:
    found = {}
    for key, name in OPERATORS.items():
        module = _module(name)
        if hasattr(module, "ORACLE"):
            found[key] = module.ORACLE
        elif hasattr(module, "oracle"):
            found[key] = module.oracle()
    return found
