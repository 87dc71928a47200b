"""One module per data product: landed inputs in, keyed table rows out."""
