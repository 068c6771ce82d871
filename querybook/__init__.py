"""Registered queries: each pairs a Spark callable with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

SECTIONS = ["corpus", "repos", "genlog", "sampling", "chat", "pairs", "io", "streams", "increments", "buffers"]


def load_all() -> None:
    for section in SECTIONS:
        importlib.import_module(f"querybook.{section}")
