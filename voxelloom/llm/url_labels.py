"""The small labelled table of URLs that the filter's model is fitted on, whole URLs with their paths, by kind of site.

WANTED are pages of well-known public sites. UNWANTED are of the kinds that public block lists name (gambling, dating and explicit sites, medicines by post, loans, copies of brands, piracy, lures for
passwords, link sellers, popups); their hosts are made up in the manner of such sites. No word of a host of the test tables stands in any of them, and tests check that.
"""

WANTED = """
https://en.wikipedia.org/wiki/Photosynthesis
https://de.wikipedia.org/wiki/Donau
https://fr.wikipedia.org/wiki/Histoire_de_la_Bretagne
https://es.wikipedia.org/wiki/Quechua
https://docs.python.org/3/library/itertools.html
https://docs.oracle.com/javase/tutorial/collections/index.html
https://developer.mozilla.org/en-US/docs/Web/HTML/Element/table
https://www.postgresql.org/docs/current/indexes-types.html
https://spark.apache.org/docs/latest/sql-programming-guide.html
https://numpy.org/doc/stable/user/basics.indexing.html
https://pandas.pydata.org/docs/user_guide/merging.html
https://stackoverflow.com/questions/231767/what-does-the-yield-keyword-do
https://math.stackexchange.com/questions/71874/can-i-use-my-powers-for-good
https://github.com/pandas-dev/pandas/issues/10000
https://www.kernel.org/doc/html/latest/process/coding-style.html
https://www.gnu.org/software/emacs/manual/html_node/emacs/Basic.html
https://www.rust-lang.org/learn/get-started
https://go.dev/doc/effective_go
https://www.w3.org/TR/xml/
https://www.rfc-editor.org/rfc/rfc2616
https://www.bbc.co.uk/news/science-environment-58041093
https://www.theguardian.com/environment/2021/aug/09/climate-report
https://www.nytimes.com/2019/07/20/science/moon-landing.html
https://www.reuters.com/article/us-space-station
https://www.lemonde.fr/sciences/article/2020/05/12/fossiles.html
https://www.zeit.de/wissen/umwelt/2021-06/hitze
https://elpais.com/cultura/2020-02-11/museo.html
https://www.spiegel.de/geschichte/alexander-von-humboldt-a-1286000.html
https://apnews.com/hub/earthquakes
https://www.npr.org/sections/health-shots/2020/03/02/vaccines
https://www.nature.com/articles/s41586-020-2649-2
https://www.science.org/doi/10.1126/science.1259855
https://arxiv.org/abs/1706.03762
https://pubmed.ncbi.nlm.nih.gov/21376230/
https://www.ncbi.nlm.nih.gov/books/NBK26887/
https://www.jstor.org/stable/2118477
https://plato.stanford.edu/entries/kant-moral/
https://ocw.mit.edu/courses/18-06-linear-algebra-spring-2010/pages/readings/
https://www.khanacademy.org/math/algebra/quadratics
https://www.cs.cmu.edu/schedule/fall.html
https://www.ox.ac.uk/about/organisation/history
https://www.uni-heidelberg.de/de/studium
https://www.sorbonne-universite.fr/la-recherche
https://www.nasa.gov/mission/voyager/
https://www.esa.int/Science_Exploration/Space_Science/Rosetta
https://www.noaa.gov/education/resource-collections/ocean-coasts/tsunamis
https://www.usgs.gov/programs/earthquake-hazards/lists-maps
https://www.metoffice.gov.uk/weather/forecast/gcpvj0v07
https://www.who.int/news-room/fact-sheets/detail/malaria
https://www.cdc.gov/flu/about/keyfacts.html
https://www.nhs.uk/conditions/asthma/symptoms/
https://www.mayoclinic.org/diseases-conditions/migraine/symptoms-causes/syc-20360201
https://www.gov.uk/renew-driving-licence
https://www.loc.gov/collections/civil-war-maps/
https://www.bnf.fr/fr/histoire-de-la-bibliotheque
https://www.britishmuseum.org/collection/galleries
https://www.louvre.fr/en/explore/the-palace
https://www.moma.org/collection/works/79802
https://www.metmuseum.org/art/collection/search/436535
https://www.gutenberg.org/ebooks/1342
https://archive.org/details/originofspecies00darwuoft
https://www.poetryfoundation.org/poems/44272/the-road-not-taken
https://www.britannica.com/science/plate-tectonics
https://www.merriam-webster.com/dictionary/serendipity
https://dictionary.cambridge.org/grammar/british-grammar/articles
https://www.allrecipes.com/recipe/21014/good-old-fashioned-pancakes/
https://www.bonappetit.com/recipe/classic-chicken-noodle-soup
https://www.chefkoch.de/rezepte/drucken/745721177147257/Lasagne.html
https://www.marmiton.org/recettes/recette_ratatouille_23223.aspx
https://www.gardenersworld.com/how-to/grow-plants/how-to-grow-tomatoes/
https://www.rspb.org.uk/birds-and-wildlife/robin
https://www.nationalgeographic.com/animals/mammals/facts/blue-whale
https://www.lonelyplanet.com/portugal/lisbon
https://www.openstreetmap.org/relation/62422
https://www.deutschebahn.com/de/konzern/geschichte
https://www.sncf-connect.com/train/trajet/paris/lyon
https://www.ikea.com/gb/en/p/billy-bookcase-white-00263850/
https://www.apple.com/newsroom/2020/11/
https://www.imdb.com/title/tt0111161/reference
https://openlibrary.org/works/OL45804W/Fantastic_Mr_Fox
https://www.chess.com/terms/sicilian-defense
https://www.fifa.com/tournaments/mens/worldcup/1998france
https://olympics.com/en/athletes/nadia-comaneci
https://www.unesco.org/en/world-heritage
https://www.un.org/en/about-us/universal-declaration-of-human-rights
https://www.amnesty.org/en/what-we-do/
https://www.economist.com/finance-and-economics/2018/09/08/the-legacy-of-lehman
https://www.federalreserve.gov/monetarypolicy/fomccalendars.htm
https://www.ecb.europa.eu/press/pr/date/2012/html/pr120906_1.en.html
https://www.hbr.org/1990/05/the-core-competence-of-the-corporation
""".split()

UNWANTED = """
http://royal-roulette-bonus.top/register?aff=1032
http://jackpot-slots-777.xyz/deposit/bonus
https://www.lucky-poker-rooms.club/signup.php?ref=88
http://blackjack-vegas-online.biz/play/now
http://sportsbook-odds-tips.info/live/odds
http://baccarat-dealer-live.site/bonus100
http://bingo-jackpots.click/join
http://megaslot-spins.vip/welcome/bonus?code=200
http://lottery-results-jackpot.online/claim
http://togel-slot-gacor.live/daftar
http://hot-singles-nearby.date/chat/8831
http://xxx-tube-clips.sex/video/44121
http://porn-gallery-hd.xyz/category/amateur
https://www.nude-cams-live.webcam/room/77
http://sexy-girls-dating.click/profile?id=12
http://escorts-tonight.club/city/london
http://milf-hookups.date/signup
http://erotic-stories-xxx.info/story/23.html
http://live-sexcams.top/models
http://camgirls-chat.webcam/private/show
http://buy-viagra-discount.biz/order.php?id=3
http://cialis-generic-rx.info/order/now
http://canadian-pharmacy-meds.top/buy/tramadol
http://xanax-no-prescription.online/checkout
http://weight-loss-miracle-diet.club/offer?sub=99
http://keto-gummies-offer.site/trial
http://hgh-steroids-shop.biz/buy/anabolic
http://rx-meds-overnight.xyz/order
http://male-enhancement-gel.click/special-offer
http://cbd-gummies-discount.shop/buy-now
http://payday-loans-instant.info/apply?aff=7
http://instant-cash-advance.top/loan/apply
http://bad-credit-loans-now.biz/quick
http://bitcoin-doubler-profit.xyz/invest
http://crypto-giveaway-x2.live/claim/eth
http://forex-signals-millionaire.club/join
http://make-money-fast-home.info/earn/5000
http://passive-income-secret.online/webinar?aff=3
http://binary-options-robot.top/start
http://nft-airdrop-claim.site/connect-wallet
http://replica-watches-outlet.shop/rolex/submariner
http://fake-handbags-outlet.store/louis/vuitton
http://discount-jerseys-wholesale.cn.example.shop/nfl
http://ray-sunglasses-outlet.top/sale90
http://designer-shoes-replica.biz/sale
http://luxury-replica-bags.xyz/cart
http://torrent-movies-hd.to.example.xyz/download/2021
http://crack-keygen-serial.info/office/2019
http://warez-cracked-games.top/download.php?id=55
http://watch-movies-online-hd.stream/full/stream
http://putlocker-streams.click/watch/episode
http://mp3-song-rips.biz/album/zip
http://keygen-serials.xyz/photoshop/crack
http://apk-mod-hack.online/unlimited/gems
http://game-hack-generator.site/coins
http://secure-paypal-login-verify.info/webscr/update
http://appleid-account-unlock.top/signin/confirm
http://bank-account-verify-alert.xyz/login.php
http://netflix-billing-update.online/verify/card
http://amazon-giftcard-claim.click/prize/confirm
http://microsoft-support-alert.site/virus/call-now
http://your-computer-infected.top/scan/alert
http://iphone-prize-claim.club/congratulations/visitor
http://survey-gift-cards.info/claim/reward?id=9
http://package-delivery-fee-pay.xyz/customs/pay
http://webmail-quota-verify.biz/login
http://seo-backlinks-rank.biz/buy/500-links
http://buy-instagram-followers.top/order/1000
http://guest-post-links-seller.info/packages
http://link-exchange-directory.xyz/submit.php
http://article-spinner-seo.click/rewrite
http://expired-domains-traffic.site/parked?d=1
http://popunder-clicks.top/redirect?zone=44
http://push-notifications-allow.click/allow?z=19
http://redirect-offers-cpa.xyz/go.php?offer=771
http://banner-click-counter.info/imp?cid=3
http://popup-redirects.site/out/891
http://toolbar-installer-setup.top/download.exe
http://driver-updater-pro-setup.biz/setup.exe
http://codec-player-update.xyz/flash/install
http://browser-hijack-search.click/search?q=offer
http://mlm-pyramid-riches.club/join/team
http://psychic-readings-love.info/chat/now
http://astrology-fortune-spell.biz/love/spell
http://essay-writers-forsale.top/order/essay
http://fake-diplomas-degrees.xyz/buy
http://passport-documents-buy.biz/order
http://darknet-market-links.site/mirror
http://vape-juice-discount.shop/order?aff=2
http://miracle-cure-secret.info/doctors-hate
""".split()

#: (url, 1 = unwanted)
LABELLED = [*((u, 0) for u in WANTED), *((u, 1) for u in UNWANTED)]
