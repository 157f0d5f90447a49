"""functions of the record pipeline."""
