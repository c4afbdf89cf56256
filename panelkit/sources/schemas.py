"""Declared types of the input tables' columns, by column name (FIXTURES.md section A)."""

from __future__ import annotations

#: Columns by type; a name has the same type in every table it occurs in.
_BY_TYPE = {
    "bigint": ["permno", "lpermno", "obs_count_in_year"],
    "int": ["exchcd", "shrcd", "dlstcd", "public_year", "public_month", "delist", "delist_year", "y_next_year"],
    "date": ["ipodate", "ipo_date", "ipo_date_x", "delist_date", "dlstdt", "namedt", "nameenddt", "nameendt",
             "linkdt", "linkenddt", "public_date", "datadate", "date"],
    "double": ["pe_op_basic", "pe_op_dil", "pe_exi", "pe_inc", "ptb", "bm", "roa", "roe", "npm", "quick_ratio",
               "de_ratio", "curr_ratio", "at_turn", "inv_turn", "at", "lt", "prcc_c", "pstk", "revtq", "shrout",
               "total_assets", "total_liabilities", "tobinq", "revenue_growth", "total_asset_growth"],
}

COLUMN_TYPES = {name: kind for kind, names in _BY_TYPE.items() for name in names}
