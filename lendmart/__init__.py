"""Credit-portfolio analytics expressed as Spark DataFrame operators and marts."""
