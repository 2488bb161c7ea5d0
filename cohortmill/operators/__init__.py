"""DataFrame in, DataFrame out: the steps of the jobs. No I/O happens here."""
