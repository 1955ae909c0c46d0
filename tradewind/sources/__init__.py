"""Readers (raw CSV, parquet test data) and sinks (CSV / parquet with observed row counts)."""

from tradewind.sources.tables import Marketplace, RawMarketplace
from tradewind.sources.testdata import load_raw_testdata, load_testdata

__all__ = ["Marketplace", "RawMarketplace", "load_raw_testdata", "load_testdata"]
