"""Readers: files, layout JSON, task sheets and inventories, and layout rows of plain texts."""
