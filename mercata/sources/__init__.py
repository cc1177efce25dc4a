"""Where rows come from and go to: CSV batches, the warehouse folder, the test tables."""
