"""Documents in, index tables in and out."""
