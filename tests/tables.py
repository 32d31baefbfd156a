"""Where the tests find the driver's tables."""

SF = "/root/testdata/sf0.001"
