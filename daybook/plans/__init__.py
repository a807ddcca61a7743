"""The jobs: export a batch, load a batch, both in a row."""
