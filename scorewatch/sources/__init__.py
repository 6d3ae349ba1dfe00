"""Sources: schemas, lake and landing scans, card feed pages, test tables."""
