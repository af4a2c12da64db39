"""Readers and parsers: episode trees (S1-S5), job collections (S6), run logs (S7), observation JSON."""
