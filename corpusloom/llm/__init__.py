"""Operators for training-data pipelines: deduplication, packing, archives, sharding, decontamination and text scans."""
