"""shelfledger: retail sales and supply-chain analytics as PySpark DataFrame functions."""
