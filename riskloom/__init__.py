"""riskloom: loan-portfolio risk and AML reports as Spark DataFrame plans."""
