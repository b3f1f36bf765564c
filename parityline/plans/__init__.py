"""Ready-made plans: the whole inventory run, and views over the test tables."""
