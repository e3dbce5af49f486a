"""Operators for preparing large text corpora (deduplication, sanitising,
archiving, decontamination, scoring, mixing). Nothing else in the library
imports this subpackage."""
