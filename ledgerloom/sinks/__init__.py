"""Writers of finished datasets."""
