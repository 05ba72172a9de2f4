"""Reports as data, and the four event families that use them."""
