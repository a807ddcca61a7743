class BatchError(Exception):
    """A batch was refused before anything of it reached the target."""
