"""DataFrame transformations over whole tables, all symbols and dates at once."""
