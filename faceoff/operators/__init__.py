"""Relational operators: reports, keyed-table maintenance, snapshots, ranking."""
