"""Broadsheet: curation of large news-article collections as Spark DataFrame operators."""

from broadsheet.settings import Settings

__all__ = ["Settings"]
