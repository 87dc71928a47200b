"""Writers: staged table replacement, partition replacement, CSV, verified rewrite."""
