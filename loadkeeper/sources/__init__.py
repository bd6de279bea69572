"""Tables and files: schemas, log appends, table versions, derived control tables."""
