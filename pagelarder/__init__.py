"""Stored web pages -> clean, uniform records, on Spark."""

from pagelarder.operators.conform import combine, recipes, rejects
from pagelarder.operators.select import page
from pagelarder.operators.shred import shred
from pagelarder.plans.crawl import run
from pagelarder.plans.extract import extract, find_links
from pagelarder.session import build_session
from pagelarder.sources import Links, SourceSpec, register_source, registered_sources
from pagelarder.sources.feed import read_job_parts, read_recipes, write_recipes
from pagelarder.sources.pages import read_pages, save_snapshot

__all__ = [
    "Links",
    "SourceSpec",
    "build_session",
    "combine",
    "extract",
    "find_links",
    "page",
    "read_job_parts",
    "read_pages",
    "read_recipes",
    "recipes",
    "register_source",
    "registered_sources",
    "rejects",
    "run",
    "save_snapshot",
    "shred",
    "write_recipes",
]
