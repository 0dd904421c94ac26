"""Tables in and out: station files, stage tables, pixel tables, product catalogues, model folders."""
