"""Building blocks shared by the plans."""
