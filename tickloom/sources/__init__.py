"""Readers, parsers and the views that give the fixture tables their market-data shapes."""
