"""pressline: stored news pages to a clean, de-duplicated article archive."""
