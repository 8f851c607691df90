"""Readers and writers: text files, dated partitions, embedding tables."""
