"""Operators for training-data pipelines: secret scans, decontamination,
passage and document de-duplication, personal data, quality, shards, packing,
language identification and embedding de-duplication."""
