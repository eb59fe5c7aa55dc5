"""Batch operators: ingest, staging, marts, features, scoring, decisions, sinks."""
