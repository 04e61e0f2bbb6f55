"""Set-based warehouse operators; each takes and returns DataFrames."""
