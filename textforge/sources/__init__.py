"""Readers and writers: text collections, vocabularies, TFRecord files, reports."""
