"""Plan building blocks that keep exact ranks, quantiles and neighbours distributed."""
