"""Operators over DataFrames: normalising, upserts, materialisation, quarantine."""
