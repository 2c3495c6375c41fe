from altiplano.plans.pipeline import main

main()
