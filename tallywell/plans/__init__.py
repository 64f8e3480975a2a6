"""Published models and the governance jobs that keep the tables in order."""
