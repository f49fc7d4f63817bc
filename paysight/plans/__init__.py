"""Stage plans (silver, gold, train, EDA) and the query catalogue."""
