"""operators of the record pipeline."""
