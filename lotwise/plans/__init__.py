"""County, region and summary jobs composed of the operators."""
